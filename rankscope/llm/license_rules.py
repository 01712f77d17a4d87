"""License detection by ordered signature rules.

A text becomes its lower-cased words with one space between. Rules are regexes over that form, each
behind a keyword: a text without the keyword never meets the regex. Overlapping detections are
resolved by priority, then length: one that lies inside a kept one is dropped. The rules are
written as families (how a license names itself) times versions and forms, some hundreds in all.

NULL and empty texts have no words, no labels and score 0. Every row is scanned by itself; only the
named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from rankscope.llm.common import strings

# fixed values: the phrases that every result counts
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class Rule:
    """``weight`` is how sure a detection makes that the license holds; a lower priority wins."""

    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]
    priority: int
    weight: float


def _version(number: str) -> str:
    """``3.0`` as words, a trailing zero optional: ``3`` or ``3 0``."""
    first, _, rest = number.partition(".")
    return first + (f"(?: {rest})?" if rest in ("", "0") else f" {rest}")


#: label, keyword, name as words, versions
_VERSIONED = (
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e", ("1.0", "2.0", "3.0")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", ("2.0", "2.1", "3.0")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", ("1.0", "3.0")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("1.0", "3.0")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e", ("1.1", "1.2", "1.3")),
    ("apache", "apache", r"apache(?: software)?(?: licen[cs]e)?", ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla public", r"mozilla public licen[cs]e", ("1.0", "1.1", "2.0")),
    ("mpl", "mpl", r"mpl", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public", r"eclipse public licen[cs]e", ("1.0", "2.0")),
    ("cddl", "common development", r"common development and distribution licen[cs]e", ("1.0", "1.1")),
    ("cpl", "common public", r"common public licen[cs]e", ("1.0",)),
    ("eupl", "european union public", r"european union public licen[cs]e", ("1.0", "1.1", "1.2")),
    ("artistic", "artistic", r"artistic licen[cs]e", ("1.0", "2.0")),
    ("osl", "open software", r"open software licen[cs]e", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic free", r"academic free licen[cs]e", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("lppl", "latex project", r"latex project public licen[cs]e", ("1.0", "1.1", "1.2", "1.3")),
    ("odbl", "open database", r"open database licen[cs]e", ("1.0",)),
    ("ofl", "open font", r"(?:sil )?open font licen[cs]e", ("1.0", "1.1")),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e", ("1.0",)),
    ("upl", "universal permissive", r"universal permissive licen[cs]e", ("1.0",)),
    ("ogl", "open government", r"open government licen[cs]e", ("1.0", "2.0", "3.0")),
)

#: label, keyword, pattern, weight
_PLAIN = (
    ("mit", "mit", r"mit licen[cs]e", 0.9),
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person", 0.95),
    ("isc", "isc", r"isc licen[cs]e", 0.9),
    ("isc", "permission to use copy", r"permission to use copy modify and or distribute this software", 0.9),
    ("bsd", "bsd", r"bsd(?: style| type)? licen[cs]e", 0.8),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms", 0.9),
    ("bsd-2-clause", "bsd", r"bsd 2 clause(?: licen[cs]e)?", 0.95),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd(?: licen[cs]e)?", 0.95),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd) bsd licen[cs]e", 0.9),
    ("bsd-3-clause", "bsd", r"bsd 3 clause(?: licen[cs]e)?", 0.95),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd(?: licen[cs]e)?", 0.95),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised) bsd licen[cs]e", 0.9),
    ("bsd-4-clause", "bsd", r"bsd 4 clause(?: licen[cs]e)?", 0.95),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use", 0.9),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", 0.9),
    ("zlib", "provided as is", r"this software is provided as is without any express or implied warranty", 0.7),
    ("boost", "boost software", r"boost software licen[cs]e", 0.95),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 0.95),
    ("unlicense", "unlicen", r"(?:the )?unlicen[cs]e", 0.8),
    ("wtfpl", "what the", r"do what the \w+ you want to public licen[cs]e", 0.95),
    ("wtfpl", "wtfpl", r"wtfpl", 0.9),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 0.95),
    ("public-domain", "public domain", r"(?:released into|dedicated to|placed in|in) the public domain", 0.8),
    ("psf", "python software", r"python software foundation licen[cs]e", 0.9),
    ("php", "php", r"php licen[cs]e", 0.8),
    ("ruby", "ruby", r"ruby licen[cs]e", 0.8),
    ("openssl", "openssl", r"openssl licen[cs]e", 0.9),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", 0.9),
    ("ncsa", "ncsa", r"ncsa open source licen[cs]e", 0.9),
    ("x11", "x11", r"x11 licen[cs]e", 0.9),
    ("spdx", "spdx", r"spdx licen[cs]e identifier", 0.5),
    ("gpl-compatible", "gpl compatible", r"gpl compatible", 0.3),
    ("reserved", "rights reserved", r"(?:all|some|no) rights reserved", 0.6),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", 0.4),
    ("copyright", "copyrighted", r"copyrighted (?:material|work)s?", 0.4),
    ("proprietary", "proprietary", r"proprietary and confidential", 0.7),
    ("proprietary", "confidential", r"confidential and proprietary", 0.7),
    ("no-redistribution", "prohibited", r"(?:reproduction|redistribution|copying)(?: of this \w+)? is (?:strictly )?prohibited", 0.7),
    ("no-redistribution", "may not be", r"may not be (?:reproduced|copied|redistributed)", 0.6),
    ("permission-required", "written permission", r"without (?:the )?(?:prior |express )*written permission", 0.5),
    ("license-notice", "ed under", r"(?:is |are )?licen[cs]ed under(?: the| a)?", 0.3),
    ("license-notice", "terms of", r"under the terms of the(?: \w+){1,6} licen[cs]e", 0.5),
    ("warranty-disclaimer", "warranties", r"without warranties or conditions of any kind", 0.5),
    ("warranty-disclaimer", "warranty", r"without (?:any|even the implied) warranty", 0.5),
)

#: element names of Creative Commons licenses and how they are written out
_COMMONS = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?deriv(?:ative|ative works|s)",
    "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative|ative works|s)",
}
_COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, the most telling first."""
    made: list[Rule] = []

    def add(label: str, keyword: str, pattern: str, priority: int, weight: float) -> None:
        bounded = re.compile(rb"(?<= )" + pattern.encode() + rb"(?= )")
        made.append(Rule(label, keyword.encode(), bounded, priority, weight))

    for label, keyword, name, versions in _VERSIONED:
        for version in versions:
            number = _version(version)
            for joint, form in ((" version ", "v"), (" v ?", "v"), (" ", "n")):
                if keyword == label and joint == " v ?":
                    joint = " ?v ?"  # short names are written as one word with their version: gplv3
                base = f"{name}{joint}{number}"
                full = f"{label}-{version}"
                weight = 0.95 if form == "v" else 0.85
                later = r"(?: of the licen[cs]e)? or (?:\(at your option\) |at your option )?(?:any )?later"
                add(f"{full}-or-later", keyword, base + later, 0, 0.98)
                add(full, keyword, base, 1, weight)
        add(label, keyword, name + (" licen[cs]e" if keyword == label else ""), 3, 0.8)
    for parts, written in _COMMONS.items():
        label = "cc-" + parts.replace(" ", "-")
        for version in _COMMONS_VERSIONS:
            number = _version(version)
            add(f"{label}-{version}", "cc", f"cc {parts} {number}", 1, 0.95)
            add(f"{label}-{version}", "creative commons", f"creative commons {written} {number}", 1, 0.95)
            longer = f"creative commons {written} (?:international |unported )?licen[cs]e(?: version)? {number}"
            add(f"{label}-{version}", "creative commons", longer, 1, 0.95)
        add(label, "cc", f"cc {parts}", 3 - len(parts.split()) / 10, 0.8)
        add(label, "creative commons", f"creative commons {written}", 3 - len(parts.split()) / 10, 0.85)
    for label, keyword, pattern, weight in _PLAIN:
        add(label, keyword, pattern, 2, weight)
    return tuple(sorted(made, key=lambda r: r.priority))


@lru_cache(maxsize=1)
def _by_keyword() -> dict[bytes, list[tuple[int, Rule]]]:
    groups: dict[bytes, list[tuple[int, Rule]]] = {}
    for number, rule in enumerate(rules()):
        groups.setdefault(rule.keyword, []).append((number, rule))
    return groups


def normal_form(text: str) -> bytes:
    """Lower-cased words, each with a space before and after."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    return b" " + b" ".join(words) + b" " if words else b""


def detect(form: bytes) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) of a text in normal form, in text order."""
    found = []
    for keyword, group in _by_keyword().items():
        if keyword in form:
            for number, rule in group:
                found += [(m.start(), m.end(), number, rule) for m in rule.pattern.finditer(form)]
    found.sort(key=lambda x: (x[3].priority, x[0] - x[1], x[0], x[2]))
    kept: list[tuple[int, int, Rule]] = []
    # the kept detections that no other kept one contains: both ends rise
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _, rule in found:
        before = bisect_right(starts, start)
        if before and ends[before - 1] >= end:
            continue
        kept.append((start, end, rule))
        at = bisect_left(starts, start)
        past = bisect_right(ends, end, at)
        starts[at:past], ends[at:past] = [start], [end]
    return sorted(kept, key=lambda x: x[:2])


def places(form: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase's words stand one after another."""
    wanted, at, words, last, out = b" " + phrase + b" ", 0, 0, 0, []
    while (at := form.find(wanted, at)) >= 0:
        words += form.count(b" ", last, at)
        out.append(words)
        last, at = at, at + 1
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, base places and labels, all labels, spans and score.

    ``spans`` lists each kept detection as ``label@first word+words``. ``score`` is one minus the
    product of the doubts that each label's surest detection leaves.
    """
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = (
        f"`{key}` {source.schema['key'].dataType.simpleString()}, n_words long, n_base long, "
        "first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<string>"
    )
    names = [key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def row(text: str) -> tuple:
        form = normal_form(text)
        found = {label: places(form, phrase.encode()) for phrase, label in PHRASES.items()}
        starts = [x for each in found.values() for x in each]
        base = sorted(label for label, each in found.items() if each)
        kept = detect(form)
        doubt: dict[str, float] = {}
        for _, _, rule in kept:
            doubt[rule.label] = min(doubt.get(rule.label, 1.0), 1 - rule.weight)
        score = 1.0
        for label in sorted({*base} - {*doubt}):
            doubt[label] = 0.3
        for label in sorted(doubt):
            score *= doubt[label]
        spans, words, last = [], 0, 0
        for a, b, rule in kept:
            words += form.count(b" ", last, a)
            last = a
            spans.append(f"{rule.label}@{words - 1}+{form.count(b' ', a, b) + 1}")
        return (
            max(0, form.count(b" ") - 1), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(base), ",".join(sorted(doubt)), 1 - score if doubt else 0.0, spans,
        )

    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = zip(*map(row, strings(batch, "text")), strict=True)
                columns = [pa.array(c, t) for c, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names)

    return source.mapInArrow(run, schema)
