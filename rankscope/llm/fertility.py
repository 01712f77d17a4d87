"""Quality rules on how well a text fits public vocabularies.

A text in a language that the vocabularies know takes few tokens for its characters, few tokens that
stand for single bytes, and its tokens vary. Keyboard noise, encoded binary, broken encodings and
repeated phrases do not. Two vocabularies are measured over the distinct words of a task, and each
language, or where that is unknown each script, has its own bands.

In Latin script the lower bounds are for the plain letters: what digits, marks and letters with accents cost
in tokens is taken off first, so lists of numbers or many accents do not make prose look like noise. Of each
of these only the share that prose or a price list may have is taken off; the tokens of the rest count, so a text
made of symbols, numbers or accents is judged by them. The
bounds lie between the prose of the given tables (1.86 letters a token and more) and random letters
(1.5 on average, 1.8 at most). A text rich in digits whose words mostly have none (prose around a key or a phone
number) has looser bounds.

A band follows from the script of most letters; the language chooses among the bands of Latin script alone, so a
wrong language does not spare a text in another known script. Texts without any letter are judged as Latin.

NULL and empty texts have no words, so they fail the base rule. A very long text is one row, its words are
measured once each. Measures on a bound (ties) stay. An empty table gives no rows. Every row is judged by itself:
repeated rows get equal results, and only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankscope.llm.common import slices, strings

WINDOW = 5
REMEMBERED = 250_000
#: characters of texts that are measured in one go
TOGETHER = 3_000_000
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
DIGITS = b"0123456789"
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
#: first bytes of Latin letters with accents, of other characters of two bytes, and of longer ones
ACCENTS, TWO_BYTES, MORE_BYTES = bytes(range(0xC3, 0xCA)), b"\xc2" + bytes(range(0xCA, 0xE0)), bytes(range(0xE0, 0xF5))
#: tokens of either vocabulary for a digit, a mark, an accented letter, another character of two bytes, a longer one
COSTS = ((1.0, 1.0, 1.0, 1.0, 2.0), (0.4, 1.0, 2.0, 2.0, 3.5))
#: the share of a text's characters up to which each of them is taken off
MOST = (0.5, 0.2, 0.3, 1.0, 1.0)
RICH = 0.1
LATIN, LETTERLESS = "LATIN", "NONE"
SCRIPTS = (LATIN, "CYRILLIC", "GREEK", "ARABIC", "HEBREW", "DEVANAGARI", "CJK", "HIRAGANA", "HANGUL")

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_tokens long, chars_per_token double, "
    "bytes_chars_per_token double, byte_share double, token_entropy double, script string, "
    "reasons string"
)


@dataclass(frozen=True)
class Band:
    """A text outside any of these is refused.

    ``entropy`` is the least entropy in bits of a text of ``LONG`` tokens or more; a shorter text
    needs the same share of the most that its token count allows. With ``letters`` the lower bounds of
    ``chars`` and ``byte_chars`` are for plain letters and ``rich`` replaces them in texts rich in digits; ``marks``
    is the largest share of marks among the characters, as runs of one mark take few tokens.
    """

    chars: tuple[float, float]
    byte_chars: tuple[float, float]
    byte_share: float
    entropy: float
    letters: bool = False
    rich: tuple[float, float] = (0.0, 0.0)
    marks: float = 1.0


LONG = 256
WESTERN = Band((1.8, 7.0), (1.8, 7.5), 0.05, 3.0, True, (1.7, 1.5), 0.3)
BANDS = {
    "en": WESTERN, "de": WESTERN, "es": WESTERN, "fr": WESTERN, LATIN: WESTERN, LETTERLESS: WESTERN,
    "CYRILLIC": Band((1.18, 6.0), (0.66, 3.0), 0.1, 3.0),
    "GREEK": Band((0.6, 4.0), (0.735, 3.0), 0.3, 3.0),
    "ARABIC": Band((0.6, 4.0), (0.66, 3.0), 0.3, 3.0),
    "HEBREW": Band((0.6, 4.0), (0.63, 3.0), 0.3, 3.0),
    "CJK": Band((0.3, 3.0), (0.25, 1.5), 0.8, 3.0),
    "HIRAGANA": Band((0.3, 3.0), (0.25, 1.5), 0.8, 3.0),
    "HANGUL": Band((0.4, 3.0), (0.25, 1.5), 0.7, 3.0),
    "OTHER": Band((0.2, 7.0), (0.2, 7.5), 0.95, 2.5),
}


class _Words(dict):
    def __init__(self) -> None:
        super().__init__()
        self.order: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.order)
        self.order.append(word)
        return number


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    single = np.array([model.is_byte(i) for i in range(model.vocab_size())])
    return model, single


@lru_cache(maxsize=2)
def _bytes(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def script_of(text: str) -> str:
    """The script of most letters; ties go to the first of ``SCRIPTS``, no letter gives NONE."""
    if text.isascii():
        return LATIN if any(map(str.isalpha, text)) else LETTERLESS
    counts = dict.fromkeys((*SCRIPTS, "OTHER"), 0)
    for char in set(text):
        if char.isalpha():
            name = unicodedata.name(char, "OTHER").split(" ")[0]
            counts[name if name in counts else "OTHER"] += text.count(char)
    return max(counts, key=counts.get) if any(counts.values()) else LETTERLESS


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in some window of five found at least twice."""
    windows = len(words) - WINDOW + 1
    if windows < 2:
        return 0
    mixed = np.zeros(windows, np.uint64)
    for k in range(WINDOW):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        mixed += words[k : k + windows].astype(np.uint64)
    order = np.argsort(mixed, kind="stable")
    equal = mixed[order][1:] == mixed[order][:-1]
    if not equal.any():
        return 0
    marks = np.zeros(len(words) + 1, np.int64)
    twice = np.zeros(windows, bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    at = np.nonzero(twice)[0]
    np.add.at(marks, at, 1)
    np.add.at(marks, at + WINDOW, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS.decode())]
    return len(lines) - len(set(lines))


class Meter:
    """Measures texts with both vocabularies, each distinct word once."""

    def __init__(self, piece_path: str, rank_path: str, pattern: str):
        self.model, self.single = _pieces(piece_path)
        self.encoding = _bytes(rank_path, pattern)
        self._forget()

    def _forget(self) -> None:
        self.words = _Words()
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.other = np.empty(0, np.int64)

    def numbers(self, raw: list[bytes]) -> list[np.ndarray]:
        if len(self.words.order) > REMEMBERED:
            self._forget()
        number = self.words.__getitem__
        known = len(self.words.order)
        each = [np.fromiter(map(number, t.split()), np.int64) for t in raw]
        new = [w.decode("utf-8", "replace") for w in self.words.order[known:]]
        if new:
            rows = self.model.encode(new, out_type=int, num_threads=1)
            flat = np.fromiter(chain.from_iterable(rows), np.int32)
            self.ids = np.concatenate([self.ids, flat])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(r) for r in rows])])
            counts = [len(self.encoding.encode_ordinary(" " + w)) for w in new]
            self.other = np.concatenate([self.other, np.array(counts, np.int64)])
        return each

    def measure(self, numbers: np.ndarray) -> tuple[int, int, int, float]:
        """Tokens of either vocabulary, tokens for single bytes, entropy in bits."""
        if not len(numbers):
            return 0, 0, 0, 0.0
        starts = self.ends[numbers]
        sizes = self.ends[numbers + 1] - starts
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        ids = self.ids[shift + np.arange(len(shift))]
        if not len(ids):
            return 0, 0, 0, 0.0
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        share = counts / len(ids)
        entropy = float(-(share * np.log2(share)).sum())
        return len(ids), int(self.other[numbers].sum()), int(self.single[ids].sum()), max(0.0, entropy)


def letters_per_token(raw: bytes, tokens: int, others: int) -> tuple[float, float, float, float]:
    """Plain letters a token of either vocabulary, without what all else may cost; the shares of digits and marks.

    A text whose other characters explain all tokens is not judged by letters.
    """

    def count(kind: bytes) -> int:
        return len(raw) - len(raw.translate(None, kind))

    letters, digits = count(LETTERS), count(DIGITS)
    marks = len(raw.translate(None, LETTERS + DIGITS + BLANKS + bytes(range(128, 256))))
    others_of = (digits, marks, count(ACCENTS), count(TWO_BYTES), count(MORE_BYTES))
    chars = max(1, letters + sum(others_of))
    known = [min(n, share * chars) for n, share in zip(others_of, MOST, strict=True)]
    left = [
        n - sum(c * k for c, k in zip(costs, known, strict=True))
        for n, costs in zip((tokens, others), COSTS, strict=True)
    ]
    per = [letters / n if n > 0 else float("inf") for n in left]
    return per[0], per[1], digits / chars, marks / chars


def least_letters(band: Band, raw: bytes, digits: float) -> tuple[float, float]:
    """The lower bounds of a text with this share of digits."""
    if digits > RICH:
        words = raw.split()
        if 2 * sum(w.translate(None, DIGITS) == w for w in words) >= len(words):
            return band.rich
    return band.chars[0], band.byte_chars[0]


def outside(
    band: Band, chars: float, byte_chars: float, byte_share: float, entropy: float, n: int, raw: bytes, others: int
) -> list[str]:
    """The names of the measures outside their bands."""
    least = band.entropy * np.log2(max(2, min(n, LONG))) / np.log2(LONG)
    found = []
    fits, byte_fits = chars >= band.chars[0], byte_chars >= band.byte_chars[0]
    if band.letters:
        per, byte_per, digits, marks = letters_per_token(raw, n, others)
        if marks > band.marks:
            found.append("mark_share")
        least_per, least_byte = least_letters(band, raw, digits)
        fits, byte_fits = per >= least_per, byte_per >= least_byte
    if not fits or chars > band.chars[1]:
        found.append("chars_per_token")
    if not byte_fits or byte_chars > band.byte_chars[1]:
        found.append("bytes_chars_per_token")
    if byte_share > band.byte_share:
        found.append("byte_share")
    if entropy < least:
        found.append("token_entropy")
    return found


def _row(meter: Meter, text: str, raw: bytes, words: np.ndarray, language: str | None) -> tuple:
    """The values of one text, in the order of ``SCHEMA``."""
    n, repeats = len(words), repeated_words(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    failed = n < 10 or 100 * repeats > 20 * n
    tokens, others, single, entropy = meter.measure(words)
    per, byte_per, share = (
        (chars / tokens, chars / max(1, others), single / tokens) if tokens else (0.0, 0.0, 0.0)
    )
    script = script_of(text)
    if script in (LATIN, LETTERLESS, "OTHER") and language in BANDS and BANDS[language].letters:
        script = language
    reasons = outside(BANDS.get(script, BANDS["OTHER"]), per, byte_per, share, entropy, tokens, raw, others)
    return (
        n, chars, symbols, repeated_lines(text), repeats, failed, not failed and not reasons,
        tokens, per, byte_per, share, entropy, script, ",".join(reasons),
    )


def judge(
    docs: DataFrame, piece_path: str, rank_path: str, pattern: str,
    key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: its key, the base counts, the measures and the verdict.

    ``reasons`` names the measures outside their bands. A text that fails the base rule is refused
    whatever its measures.
    """
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"), docs[lang].alias("lang"))
    first = source.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(piece_path, rank_path, pattern)
        for batch in batches:
            rows = []
            texts, languages = strings(batch, "text"), batch.column("lang").to_pylist()
            for part in slices(texts, TOGETHER):
                raw = [t.encode("utf-8", "surrogatepass") for t in texts[part]]
                each = zip(texts[part], raw, meter.numbers(raw), languages[part], strict=True)
                rows += [_row(meter, *one) for one in each]
            columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names)

    names = [key, *(field.split(" ")[0] for field in SCHEMA.split(", "))]
    return source.mapInArrow(run, f"`{key}` {first.simpleString()}, {SCHEMA}")
