from __future__ import annotations

import random
import re
import time
from re import _parser as parser

from tables import TINY

from rankscope.llm import license_rules
from rankscope.llm.queries import license_scan

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text: str | None):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower.encode())
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_query_base_columns(spark, tiny_docs):
    rows = {r.doc_id: r for r in license_scan(spark, TINY).collect()}
    for doc in tiny_docs.itertuples():
        r = rows[doc.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(doc.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def labels(text: str) -> list[str]:
    return [rule.label for *_, rule in license_rules.detect(license_rules.normal_form(text))]


def test_priority_and_containment():
    assert labels("Licensed under the Apache License, Version 2.0 (the License)") == ["license-notice", "apache-2.0"]
    assert labels("GNU Lesser General Public License version 2.1 or later") == ["lgpl-2.1-or-later"]
    assert labels("GNU General Public License, version 3") == ["gpl-3.0"]
    assert labels("CC BY-NC-SA 4.0") == ["cc-by-nc-sa-4.0"]
    assert labels("2-Clause BSD License") == ["bsd-2-clause"]
    assert labels("nothing of the kind, accgpl mitx") == []


def test_british_spelling_and_short_forms():
    for name, label in (("MIT Licence", "mit"), ("PHP Licence", "php"), ("Ruby Licence", "ruby"), ("BSD Licence", "bsd")):
        assert labels(f"the {name}.") == [label] == labels(f"the {name.replace('ence', 'ense')}.")
    assert labels("This is licenced under it") == ["license-notice"] == labels("This is licensed under it")
    assert labels("GPLv3") == ["gpl-3.0"] == labels("GPL v3") == labels("GPL-3.0")
    assert labels("GPLv2+ or GPLv2 or later") == ["gpl-2.0", "gpl-2.0-or-later"]
    assert labels("LGPLv2.1, MPLv2, AGPLv3.0") == ["lgpl-2.1", "mpl-2.0", "agpl-3.0"]
    assert labels("Apachev2") == ["apache-2.0"]
    assert labels("gplv33 xgplv3") == []


def spellings(parts) -> list[str]:
    """Texts that a parsed pattern matches: each branch, each of a set, nothing or one of what may be left out."""
    made = [""]
    for kind, value in parts:
        name = str(kind)
        if name == "LITERAL":
            each = [chr(value)]
        elif name == "IN":
            kinds = {str(k) for k, _ in value}
            each = [chr(v) for k, v in value if str(k) == "LITERAL"] if kinds == {"LITERAL"} else ["1"]
        elif name == "SUBPATTERN":
            each = spellings(value[-1])
        elif name == "BRANCH":
            each = [x for branch in value[1] for x in spellings(branch)]
        elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT"):
            low, _, inner = value
            once = spellings(inner)
            each = [x * low for x in once] + [x * (low + 1) for x in once]
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
            each = [""]
        made = list(dict.fromkeys(a + b for a in made for b in each))
    return made


def test_each_keyword_is_in_all_spellings_of_its_pattern():
    for rule in license_rules.rules():
        keyword = rule.keyword.decode()
        parsed = parser.parse(rule.pattern.pattern.decode().replace(r"\\w", "1").replace(r"\\d", "1"))
        assert [x for x in spellings(parsed) if keyword not in x] == [], (rule.label, keyword)


def test_there_are_hundreds_of_rules_in_order():
    rules = license_rules.rules()
    assert len(rules) > 300 and [r.priority for r in rules] == sorted(r.priority for r in rules)


def test_overlapping_places():
    form = license_rules.normal_form("cc by cc by cc cc by")
    assert license_rules.places(form, b"cc by") == [0, 2, 5]


def test_odd_rows(spark, odd_docs):
    rows = license_rules.scan(odd_docs.withColumnRenamed("shard", "labels")).collect()
    assert len(rows) == odd_docs.count()
    first = next(r for r in rows if r.doc_id == 1)
    assert (first.n_words, first.n_base, first.first_word, first.labels, first.score, first.spans) == (0, 0, None, "", 0, [])
    assert license_rules.scan(odd_docs.limit(0)).count() == 0


def test_detections_against_comparing_all():
    words = "gnu general public license version 2 3 or later mit cc by sa 4 0 bsd clause under the terms of".split()
    rng = random.Random(5)
    for _ in range(300):
        form = license_rules.normal_form(" ".join(rng.choices(words, k=rng.randrange(1, 100))))
        found = [
            (m.start(), m.end(), number, rule)
            for number, rule in enumerate(license_rules.rules()) for m in rule.pattern.finditer(form)
        ]
        kept: list[tuple] = []
        for start, end, _, rule in sorted(found, key=lambda x: (x[3].priority, x[0] - x[1], x[0], x[2])):
            if not any(a <= start and end <= b for a, b, _ in kept):
                kept.append((start, end, rule))
        assert license_rules.detect(form) == sorted(kept, key=lambda x: x[:2])


def test_a_very_long_text_with_a_detection_everywhere(spark):
    part, times = "some words under the mit license and ", 40_000
    docs = spark.createDataFrame([(1, part * times)], "doc_id long, text string")
    began = time.monotonic()
    row = license_rules.scan(docs).first()
    assert time.monotonic() - began < 60
    mit = [s for s in row.spans if s.startswith("mit@")]
    assert mit == [f"mit@{7 * i + 4}+2" for i in range(times)] and row.n_words == 7 * times
