"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

Numbers and dates that pass their check (Luhn, calendar, ranges) are permuted inside their own format
by a keyed Feistel network, so a pseudonym is again a valid number of the kind, equal values get
equal pseudonyms in all documents, and the key's holder can invert it. A format with ``a * b`` values is
permuted as a pair (left below ``a``, right below ``b``) to which keyed digests of the other half are
added in turn; no value falls outside, so nothing is tried again. The local part of a mail address
and the rest of an access key, which have no number, become keyed text of the same length class.

Each kind has one pattern. A text is cut once at the matches of any and put together again with the
pseudonyms in their place; a match that fails its check stays as it is. NULL and empty texts pass unchanged, as
do all other columns, whatever their names. A very long text is one row, cut once. Where kinds tie on a place the first
of ``KINDS`` counts. Each row is treated by itself: repeated rows stay equal, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import hex_number

ROUNDS = 8
DIGEST_HEX = 13


def feistel(
    value: Column, left_size: int | Column, right_size: int | Column, key: str, tweak: str, inverse: bool = False
) -> Column:
    """A keyed permutation of 0 .. ``left_size * right_size - 1``.

    ``ROUNDS`` times the digest of one half is added to the other, modulo that half's size.
    ``inverse`` takes it back.
    """
    low = F.pmod(value, F.lit(right_size))
    start = F.struct(
        ((value - low) / right_size).cast("long").alias("l"), low.cast("long").alias("r")
    )

    def digest(half: Column, number: Column) -> Column:
        text = F.concat_ws(":", F.lit(key), F.lit(tweak), number.cast("string"), half.cast("string"))
        return hex_number(F.md5(text), 1, DIGEST_HEX)

    sign = -1 if inverse else 1

    def turn(state: Column, number: Column) -> Column:
        even = number % 2 == 0
        left = F.pmod(state["l"] + sign * F.pmod(digest(state["r"], number), F.lit(left_size)), F.lit(left_size))
        right = F.pmod(state["r"] + sign * F.pmod(digest(state["l"], number), F.lit(right_size)), F.lit(right_size))
        return F.struct(
            F.when(even, left).otherwise(state["l"]).alias("l"), F.when(even, state["r"]).otherwise(right).alias("r")
        )

    numbers = [F.lit(i) for i in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))]
    return F.aggregate(F.array(*numbers), start, turn, lambda s: s["l"] * right_size + s["r"])


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(number: Column, doubled_first: bool) -> Column:
    """Luhn sum of a digit string; from the right, every other digit doubled, the last one if asked."""
    size = F.length(number)
    parity = 0 if doubled_first else 1
    places = F.sequence(F.lit(1), size)

    def worth(place: Column) -> Column:
        digit = F.substring(number, place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when((size - place) % 2 == parity, twice).otherwise(digit)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda total, x: total + x)


def refill(template: Column, number: Column) -> Column:
    """``template`` with its digits replaced in turn by those of ``number``, separators kept."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

    def step(state: Column, char: Column) -> Column:
        is_digit = char.between("0", "9")
        return F.struct(
            F.concat(state["text"], F.when(is_digit, F.substring(number, state["next"], F.lit(1))).otherwise(char)).alias("text"),
            (state["next"] + F.when(is_digit, 1).otherwise(0)).alias("next"),
        )

    return F.aggregate(F.split(template, ""), start, step, lambda s: s["text"])


def padded(number: Column, size: int) -> Column:
    return F.lpad(number.cast("string"), size, "0")


def card(text: Column, key: str) -> Column:
    """Payment cards of 16 digits that pass Luhn; the first digit and the separators stay."""
    return _card(text, key, 16, 1, "card")


def _card(text: Column, key: str, size: int, kept: int, tweak: str) -> Column:
    """Cards of ``size`` digits that pass Luhn; the first ``kept`` digits and the separators stay."""
    number, inner = digits(text), size - 1 - kept
    half = inner // 2
    middle = feistel(F.substring(number, kept + 1, inner).cast("long"), 10**half, 10 ** (inner - half), key, tweak)
    body = F.concat(F.substring(number, 1, kept), padded(middle, inner))
    check = F.pmod(10 - luhn_sum(body, True) % 10, F.lit(10)).cast("string")
    valid = (F.length(number) == size) & (luhn_sum(number, False) % 10 == 0)
    return F.when(valid, refill(text, F.concat(body, check))).otherwise(text)


def short_card(text: Column, key: str) -> Column:
    """Cards of 15 or 14 digits that pass Luhn; the two digits that name their issuer stay."""
    long = F.length(digits(text)) == 15
    return F.when(long, _card(text, key, 15, 2, "card15")).otherwise(_card(text, key, 14, 2, "card14"))


def remainder_97(number: Column) -> Column:
    """A string of digits and capital letters (A is 10, Z is 35) as a number, modulo 97."""

    def step(state: Column, char: Column) -> Column:
        letter = char >= "A"
        value = F.when(letter, F.ascii(char) - 55).otherwise(F.ascii(char) - 48)
        return F.pmod(state * F.when(letter, 100).otherwise(10) + value, F.lit(97))

    return F.aggregate(F.filter(F.split(number, ""), lambda c: c != ""), F.lit(0), step)


#: digits of an account number that are permuted, the last ones; a longer bank code in front stays
ACCOUNT = 16


def account(text: Column, key: str) -> Column:
    """International account numbers whose check digits hold; the country, letters and blanks stay."""
    plain = F.regexp_replace(text, " ", "")
    country, inner = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    number = digits(inner)
    size = F.least(F.length(number), F.lit(ACCOUNT))
    lead = F.substring(number, F.lit(1), F.length(number) - size)
    half = F.floor(size / 2)
    left, right = F.pow(F.lit(10), half).cast("long"), F.pow(F.lit(10), size - half).cast("long")
    tail = F.substring(number, F.length(number) - size + 1, size).cast("long")
    made = F.lpad(feistel(tail, left, right, key, "account").cast("string"), size, F.lit("0"))
    body = F.concat(lead, made)
    check = F.lpad((98 - remainder_97(F.concat(refill(inner, body), country, F.lit("00")))).cast("string"), 2, "0")
    rotated = F.concat(inner, F.substring(plain, 1, 4))
    # below a few digits there is nothing to permute
    valid = (F.length(number) >= 6) & F.length(plain).between(15, 34) & (remainder_97(rotated) == 1)
    # what fails may be a card behind some other mark
    behind = F.concat(F.substring(text, 1, 5), card(F.substring(text, F.lit(6), F.length(text)), key))
    return (
        F.when(valid, refill(text, F.concat(check, body)))
        .when(text.rlike("^.{4} (?:" + _CARD + ")$"), behind)
        .otherwise(text)
    )


def phone(text: Column, key: str) -> Column:
    """Ten-digit numbers whose area has no leading zero; so has the pseudonym. A country code stays."""
    number = F.substring(digits(text), -10, 10)
    lead = F.substring(digits(text), F.lit(1), F.length(digits(text)) - 10)
    area, rest = F.substring(number, 1, 3).cast("long"), F.substring(number, 4, 7).cast("long")
    made = feistel((area - 100) * 10_000_000 + rest, 900_000, 10_000, key, "phone")
    local = F.pmod(made, F.lit(10_000_000))
    out = F.concat(lead, padded(((made - local) / 10_000_000).cast("long") + 100, 3), padded(local, 7))
    return F.when(area >= 100, refill(text, out)).otherwise(text)


#: country codes of one and two digits; all others have three
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def zero_area(text: Column, key: str) -> Column:
    """Ten-digit numbers whose area has a leading zero; so has the pseudonym."""
    number = F.substring(digits(text), -10, 10)
    lead = F.substring(digits(text), F.lit(1), F.length(digits(text)) - 10)
    made = feistel(number.cast("long"), 100_000, 10_000, key, "phone0")
    return refill(text, F.concat(lead, padded(made, 10)))


def abroad(text: Column, key: str) -> Column:
    """Numbers with a country code other than 1, which stays; the rest keeps its length."""
    number = digits(text)
    lead = F.regexp_extract(number, COUNTRY, 0)
    rest = F.substring(number, F.length(lead) + 1, F.lit(15))
    size = F.length(rest)
    left = F.pow(F.lit(10), F.floor(size / 2)).cast("long")
    right = F.pow(F.lit(10), size - F.floor(size / 2)).cast("long")
    made = feistel(rest.cast("long"), left, right, key, "abroad")
    return refill(text, F.concat(lead, F.lpad(made.cast("string"), size, F.lit("0"))))


def any_phone(text: Column, key: str) -> Column:
    """Phones of any area and country."""
    area = F.substring(F.substring(digits(text), -10, 10), 1, 3).cast("int")
    return (
        F.when(text.rlike(r"^\+[2-9]"), abroad(text, key))
        .when(area < 100, zero_area(text, key))
        .otherwise(phone(text, key))
    )


def address(text: Column, key: str) -> Column:
    """Dotted addresses of four numbers below 256; the pseudonym has numbers below 256 too."""
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("long"))
    at = lambda i: F.element_at(parts, i)
    index = (at(1) * 256 + at(2)) * 65_536 + at(3) * 256 + at(4)
    made = feistel(index, 65_536, 65_536, key, "address")
    byte = lambda shift: F.pmod(F.shiftright(made, shift), F.lit(256)).cast("string")
    valid = F.forall(parts, lambda p: p < 256)
    return F.when(valid, F.concat_ws(".", byte(24), byte(16), byte(8), byte(0))).otherwise(text)


def social(text: Column, key: str) -> Column:
    """Social security numbers: area 001-899 without 666, group 01-99, serial 0001-9999."""
    number = digits(text)
    area, group, serial = (F.substring(number, a, n).cast("long") for a, n in ((1, 3), (4, 2), (6, 4)))
    slot = F.when(area > 666, area - 2).otherwise(area - 1)
    made = feistel((slot * 99 + group - 1) * 9_999 + serial - 1, 898 * 99, 9_999, key, "social")
    pair = ((made - F.pmod(made, F.lit(9_999))) / 9_999).cast("long")
    slot = ((pair - F.pmod(pair, F.lit(99))) / 99).cast("long")
    out = F.concat(
        padded(F.when(slot > 664, slot + 2).otherwise(slot + 1), 3),
        padded(F.pmod(pair, F.lit(99)) + 1, 2),
        padded(F.pmod(made, F.lit(9_999)) + 1, 4),
    )
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, refill(text, out)).otherwise(text)


FIRST_DAY, DAYS = "1900-01-01", 319 * 229  # 1900-01-01 to 2099-12-31


def date(text: Column, key: str) -> Column:
    """Dates ``yyyy-mm-dd`` (or ``/``, ``.``) from 1900 to 2099 that the calendar has."""
    plain = F.regexp_replace(text, "[./]", "-")
    day = F.try_to_date(plain, "yyyy-MM-dd")
    index = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    made = F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(index, 319, 229, key, "date").cast("int"))
    out = F.date_format(made, "yyyyMMdd")
    valid = day.isNotNull() & index.between(0, DAYS - 1)
    return F.when(valid, refill(text, out)).otherwise(text)


def written_date(text: Column, key: str) -> Column:
    """Dates with the year behind: month first where that is a date and the sign is ``/``, else day first."""
    plain = F.regexp_replace(text, "[./]", "-")
    month_first = F.when(text.contains("/"), F.try_to_date(plain, "MM-dd-yyyy"))
    day = F.coalesce(month_first, F.try_to_date(plain, "dd-MM-yyyy"))
    index = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    made = F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(index, 319, 229, key, "date").cast("int"))
    out = F.when(month_first.isNotNull(), F.date_format(made, "MMddyyyy")).otherwise(F.date_format(made, "ddMMyyyy"))
    valid = day.isNotNull() & index.between(0, DAYS - 1)
    return F.when(valid, refill(text, out)).otherwise(text)


def mail(text: Column, key: str) -> Column:
    """Mail addresses: a keyed local part at a reserved host."""
    name = F.substring(F.md5(F.concat_ws(":", F.lit(key), F.lit("mail"), F.lower(text))), 1, 16)
    return F.concat(F.lit("u"), name, F.lit("@mail.invalid"))


def secret(text: Column, key: str) -> Column:
    """Access keys and passwords: the name in front stays, the value becomes a keyed digest mark."""
    lead = F.regexp_extract(text, SECRET_LEAD, 0)
    value = F.substring(F.md5(F.concat_ws(":", F.lit(key), F.lit("secret"), text)), 1, 12)
    return F.concat(lead, F.lit("<"), value, F.lit(">"))


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds candidates; ``gate`` is a cheap condition that each text with one meets."""

    name: str
    pattern: str
    gate: Callable[[Column], Column]
    pseudonym: Callable[[Column, str], Column]


def _at_sign(text: Column) -> Column:
    return text.contains("@")


def _two_digits(text: Column) -> Column:
    return text.rlike("[0-9][0-9]")


def _four_numbers(text: Column) -> Column:
    return text.rlike(r"[0-9]\.[0-9]")


def _secret_word(text: Column) -> Column:
    lower = F.lower(text)
    words = ("akia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "passw", "pwd", "token", "secret", "api_key", "api-key", "apikey")
    return reduce(or_, [lower.contains(w) for w in words])


_NAMES = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)"
SECRET_LEAD = rf"^(?:{_NAMES}\s*[=:]\s*[\x22']?)?"
_AFTER = "(?![0-9A-Za-z])"
#: what stands before a candidate; each pattern follows it
BEFORE = "(?<![0-9A-Za-z])"
_CARD = r"[0-9]{4}(?:[ -]?[0-9]{4}){3}" + _AFTER
_SHORT_CARD = r"3(?:[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}|[068][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{4})" + _AFTER
_ACCOUNT = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _AFTER
_WRITTEN = r"[0-9]{2}(?:\.[0-9]{2}\.|/[0-9]{2}/|-[0-9]{2}-)(?:19|20)[0-9]{2}" + _AFTER
_SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_ADDRESS = r"(?<![.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
_LOCAL = r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _AFTER
#: a number abroad ends before a value of another kind
_OTHER = rf"[ ](?:{_CARD}|{_SOCIAL}|{_ADDRESS}|{_LOCAL}|(?:19|20)[0-9]{{2}}[./-][0-9]{{2}}[./-][0-9]{{2}}{_AFTER})"
_PHONE = (
    rf"(?:\+?1[ .-]?)?{_LOCAL}"
    rf"|\+1(?:[ .()-]{{0,2}}[0-9]){{10}}{_AFTER}"
    rf"|\+[2-9][0-9]{{6,14}}{_AFTER}"
    rf"|\+[2-9](?:(?!{_OTHER})[ .()-]{{0,2}}[0-9]){{6,14}}{_AFTER}"
)
KINDS = (
    Kind("mail", r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}", _at_sign, mail),
    Kind(
        "secret",
        rf"(?:{_NAMES}\s{{0,3}}[=:]\s{{0,3}}[\x22']?[A-Za-z0-9_+/-]{{8,}}+)"
        rf"|AKIA[A-Z0-9]{{16}}{_AFTER}|gh[pousr]_[A-Za-z0-9]{{36}}{_AFTER}",
        _secret_word, secret,
    ),
    Kind("account", _ACCOUNT, _two_digits, account),
    Kind("card", _CARD, _two_digits, card),
    Kind("short card", _SHORT_CARD, _two_digits, short_card),
    Kind("phone", _PHONE, _two_digits, any_phone),
    Kind("social", _SOCIAL, _two_digits, social),
    Kind("address", _ADDRESS, _four_numbers, address),
    Kind("date", r"(?:19|20)[0-9]{2}([./-])[0-9]{2}\1[0-9]{2}" + _AFTER, _two_digits, date),
    Kind("written date", _WRITTEN, _two_digits, written_date),
)


ANY = BEFORE + "(?:" + "|".join(f"(?:{k.pattern})" for k in KINDS) + ")"


def gate(text: Column) -> Column:
    """A condition that each text with a candidate of some kind meets."""
    return reduce(or_, [g(text) for g in dict.fromkeys(k.gate for k in KINDS)]) & text.rlike(ANY)


def pseudonyms_in(text: Column, key: str) -> Column:
    """``text`` with the values of all kinds replaced; only texts with a candidate are taken apart.

    Candidates are found from left to right; where several kinds fit, the first of ``KINDS`` counts.
    """

    def made(found: Column) -> Column:
        out = found
        for kind in reversed(KINDS):
            out = F.when(found.rlike(f"^(?:{kind.pattern})$"), kind.pseudonym(found, key)).otherwise(out)
        return out

    replaced = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), made)
    # one stretch more than matches: the last is followed by nothing
    parts = F.arrays_zip(F.split(text, ANY, -1).alias("rest"), replaced.alias("made"))
    joined = F.transform(parts, lambda p: F.concat(p["rest"], F.coalesce(p["made"], F.lit(""))))
    return F.when(gate(text), F.array_join(joined, "")).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in its text replaced."""
    return docs.withColumn(text, pseudonyms_in(F.col(text), key))


def candidates(text: Column) -> Column:
    """All candidates of a text, in order."""
    return F.when(gate(text), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
