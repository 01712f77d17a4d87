from __future__ import annotations

import base64
import random
import re
import string
from collections import Counter

from pyspark.sql import functions as F
from tables import TINY

from rankscope.llm import fertility
from rankscope.llm.queries import PATTERN, PIECES, RANKS, fertility_rules


def brute(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, lines, len(inside), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_of_the_query(spark, tiny_docs):
    got = fertility_rules(spark, TINY).toPandas().set_index("doc_id")
    for row in tiny_docs.itertuples():
        assert tuple(got.loc[row.doc_id, BASE]) == brute(row.text), row.doc_id
    assert not (got.kept & got.base_failed).any()
    # invented prose is no noise, unless it is strewn with marks
    assert set(got.reasons[~got.base_failed & ~got.kept]) <= {"mark_share"}


def test_noise_is_refused(spark):
    noise = " ".join("xq zvkj wqpx kzzq jxvq qwzk vvxj kqjz zxqw jkvq".split() * 1)
    rows = [
        (1, "กขꀀꀁ " * 3 + " ".join(chr(0x1F300 + i) * 3 for i in range(20)), "en"),
        (2, " ".join(f"{i:032x}" for i in range(10**30, 10**30 + 40)), "en"),
        (3, "It was a bright cold day in April, and the clocks were striking thirteen for everyone there.", None),
        (4, noise, "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in fertility.judge(docs, PIECES, RANKS, PATTERN).collect()}
    assert not got[1].kept and "byte_share" in got[1].reasons
    assert not got[2].kept
    assert got[3].kept and got[3].script == "LATIN"


def test_odd_rows(spark, odd_docs):
    rows = fertility.judge(odd_docs, PIECES, RANKS, PATTERN).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept
    assert by_id[3].n_words == 30_001 and by_id[3].base_failed
    assert fertility.judge(odd_docs.limit(0), PIECES, RANKS, PATTERN).count() == 0


def test_keyboard_noise_and_encoded_binary_are_refused_and_prose_stays(spark):
    draw = random.Random(3)

    def words(letters: str, n: int) -> str:
        return " ".join("".join(draw.choices(letters, k=draw.randint(3, 9))) for _ in range(n))

    lower = string.ascii_lowercase
    noise = [words(a, n) for n in (15, 40, 200) for a in (lower, lower.upper(), "bcdfghjklmnpqrstvwxz", "asdfghjkl", lower + string.digits)]
    noise += [" ".join(base64.b64encode(draw.randbytes(45)).decode() for _ in range(n)) for n in (12, 40)]
    noise += [" ".join(draw.randbytes(16).hex() for _ in range(n)) for n in (12, 40)]
    # noise with numbers between has no looser bounds
    noise += [" ".join(f"{w} {draw.randint(10, 9999)}" for w in words(lower, 40).split())]
    noise += ["xq zvkj wqpx kzzq jxvq qwzk vvxj kqjz zxqw jkvq"]
    prose = [
        "It was a bright cold day in April, and the clocks were striking thirteen for everyone there.",
        "IT WAS A BRIGHT COLD DAY IN APRIL, AND THE CLOCKS WERE STRIKING THIRTEEN FOR EVERYONE THERE.",
        "Der schnelle braune Fuchs springt über den faulen Hund, während die Kinder im Garten spielen und lachen.",
        "En un lugar de la Mancha, de cuyo nombre no quiero acordarme, no ha mucho tiempo que vivía un hidalgo.",
        "Longtemps, je me suis couché de bonne heure. Parfois, à peine ma bougie éteinte, mes yeux se fermaient si vite.",
        "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím.",
        "Please call the office at +1 (168) 555-5254 before noon, the card 8316107434564120 was refused again.",
    ]
    docs = spark.createDataFrame(list(enumerate(noise + prose)), "doc_id long, text string")
    for lang in (None, "en", "de", "es", "fr"):
        rows = fertility.judge(docs.withColumn("lang", F.lit(lang).cast("string")), PIECES, RANKS, PATTERN).collect()
        kept = {r.doc_id for r in rows if r.kept}
        assert kept == set(range(len(noise), len(noise) + len(prose))), lang


def test_prose_of_the_tables_stays_and_texts_strewn_with_marks_go(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = [r for r in fertility_rules(spark, "/root/testdata/sf0.01").collect() if not r.base_failed]
    blanks = string.whitespace

    def marks(text: str) -> float:
        shown = [c for c in text if c not in blanks]
        return sum(c.isascii() and not c.isalnum() for c in shown) / len(shown)

    strewn = {r.doc_id for r in rows if marks(texts[r.doc_id]) > 0.3}
    assert strewn and {r.doc_id for r in rows if not r.kept} == strewn
    assert {r.reasons for r in rows if r.doc_id in strewn} == {"mark_share"}


def test_noise_in_marks_digits_accents_and_other_scripts_is_refused(spark):
    draw = random.Random(5)
    kinds = {
        "marks": "#*$%&|<>!?;:()[]{}@^~", "digits": string.digits, "accents": "éèêëàâäùûüôöîïçñáíóúßøåæ",
        "cyrillic": "".join(map(chr, range(0x430, 0x450))), "arabic": "".join(map(chr, range(0x627, 0x63B))),
        "greek": "".join(map(chr, range(0x3B1, 0x3CA))), "hangul": "".join(map(chr, range(0xAC00, 0xD7A4))),
    }
    noise = [" ".join("".join(draw.choices(a, k=draw.randint(3, 9))) for _ in range(60)) for a in kinds.values()]
    prose = [
        "Apples 1.20 EUR per kg, pears 2.50 EUR per kg, cherries 7.90 EUR per kg, plums 3.10 EUR per kg, bread 2.75 EUR, milk 1.09 EUR",
        "A4 paper 500 sheets $4.99; toner 12A $39.90; USB cable 2 m $3.49; HDMI 2.1 $12.00; mouse $9.95; keyboard $24.90",
        "Яблоки 1.20 руб за кг, груши 2.50 руб за кг, вишня 7.90 руб за кг, сливы 3.10 руб за кг, хлеб 2.75 руб",
        "The word свобода means freedom and the word правда means truth, while дружба is friendship and любовь is love in the Russian language as spoken today",
        "Слово freedom означает свобода, а слово truth означает правда, и friendship означает дружба в английском языке, на котором говорят сегодня",
        "Сегодня утром мы пошли в магазин, чтобы купить хлеб, молоко и немного сыра, но магазин был закрыт из-за праздника.",
        "Σήμερα το πρωί πήγαμε στο κατάστημα για να αγοράσουμε ψωμί, γάλα και λίγο τυρί, αλλά το κατάστημα ήταν κλειστό λόγω της αργίας.",
        "ذهبنا هذا الصباح إلى المتجر لشراء الخبز والحليب وقليل من الجبن، لكن المتجر كان مغلقا بسبب العطلة.",
        "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다.",
    ]
    docs = spark.createDataFrame(list(enumerate(noise + prose)), "doc_id long, text string")
    for lang in (None, "en", "fr"):
        rows = fertility.judge(docs.withColumn("lang", F.lit(lang).cast("string")), PIECES, RANKS, PATTERN).collect()
        kept = {r.doc_id: r.reasons for r in rows if r.kept}
        assert set(kept) == set(range(len(noise), len(noise) + len(prose))), (lang, rows)


def test_measures_and_verdict_against_a_plain_version(spark, tiny_docs):
    """Words one by one, through the vocabularies' own libraries."""
    import math

    import sentencepiece
    import tiktoken

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in fertility_rules(spark, TINY).collect()}
    for row in tiny_docs.itertuples():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        ids = [i for w in words for i in model.encode(w)]
        others = sum(len(encoding.encode_ordinary(" " + w)) for w in words)
        chars, r = sum(map(len, words)), got[row.doc_id]
        assert r.n_tokens == len(ids)
        if not ids:
            continue
        shares = [n / len(ids) for n in Counter(ids).values()]
        assert math.isclose(r.chars_per_token, chars / len(ids)) and math.isclose(r.bytes_chars_per_token, chars / others)
        assert math.isclose(r.byte_share, sum(map(model.is_byte, ids)) / len(ids))
        assert math.isclose(r.token_entropy, -sum(p * math.log2(p) for p in shares), abs_tol=1e-9)
        assert r.kept == (not r.base_failed and not r.reasons)
