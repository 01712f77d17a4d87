"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankscope.llm import (
    byte_bpe,
    fertility,
    language_cnn,
    license_rules,
    main_content,
    mixing,
    nb_ngrams,
    ngram_join,
    periodic_runs,
    pseudonyms,
    pstable,
    shard_propagation,
    source_divergence,
)
from rankscope.llm.common import cut, strings, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
PRIVATE_KEY = "rankscope-demo-key"

MIX_SHARE = 0.6
MIX_SEED = 20
MIX_WEIGHTS = {
    "domain": {"crawl": 2, "books": 3, "forums": 1, "reference": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
}


def domain_of(source: Column) -> Column:
    """The domain of a source of the test data: the hot one is a crawl, the others follow their number."""
    number = F.try_element_at(F.regexp_extract_all(source, F.lit("[0-9]+"), F.lit(0)), F.lit(1)).cast("int") % 3
    return (
        F.when(source == "src0", "crawl").when(number == 0, "books").when(number == 1, "forums")
        .when(number == 2, "reference").otherwise("")
    )


def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all texts, digests of their ids and of the bytes that these decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe.Encoder(RANKS, PATTERN)
        for batch in cut(batches, "text", byte_bpe.TOGETHER):
            flat, bounds = encoder.encode(strings(batch, "text"))
            flat = flat.astype("<u4")
            ids = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            coded = [hashlib.sha256(x.tobytes()).hexdigest() for x in ids]
            decoded = [hashlib.sha256(byte_bpe.decode_ids(RANKS, x)).hexdigest() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"), PIECES, RANKS, PATTERN)


def propagated_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_propagation.shard_texts(table(spark, sf_dir, "documents"))


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def language_network(docs: DataFrame) -> language_cnn.Network | None:
    """A network that learns from the rows of ``docs`` that are not held out."""
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return language_cnn.fit(docs.filter(~held_out(F.col("doc_id"))), F.coalesce(order, F.lit(0.5)))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    said = language_cnn.language(language_network(docs), F.col("text"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), said.alias("said"))
    return rows.select("doc_id", "held_out", "said.lang_pred", "said.score")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_vectors(table(spark, sf_dir, "embeddings"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_content.extract(pages, main_content.learn(pages))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(table(spark, sf_dir, "documents"))


def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.select(
        table(spark, sf_dir, "documents"), MIX_SHARE, MIX_WEIGHTS, domain_of(F.col("source")), MIX_SEED, epochs=2
    )
    return taken.select(F.col("row.doc_id").alias("doc_id"), *mixing.LEVELS, "epoch", "n_tokens", "tokens_before", "budget")


def near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents"))


def pseudonymised(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.size(pseudonyms.candidates(F.col("text"))).cast("long").alias("n_found"),
        pseudonyms.pseudonyms_in(F.col("text"), PRIVATE_KEY).alias("text"),
    )


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept_back = held_out(F.col("doc_id"), 5, 0)
    model = nb_ngrams.fit(nb_ngrams.labelled(docs, table(spark, sf_dir, "labels"), ~kept_back))
    return nb_ngrams.score(docs, model, kept_back)


def repeated_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"), plant=True)


def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": bpe_digests,
    "op2_fertility": fertility_rules,
    "op3_shard_propagation": propagated_shards,
    "op4_language_cnn": language_id,
    "op5_pstable": near_vectors,
    "op6_main_content": main_text,
    "op7_license_rules": license_scan,
    "op8_mixing": weighted_mix,
    "op9_ngram_join": near_texts,
    "op10_pseudonyms": pseudonymised,
    "op11_toxicity": toxicity,
    "op12_periodic_runs": repeated_stretches,
    "op13_source_divergence": source_audit,
}
