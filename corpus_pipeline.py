"""Documents to token ids in five stages; each works on all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankscope.llm import byte_bpe, language_cnn, mixing, ngram_join, pseudonyms
from rankscope.llm.common import store, table
from rankscope.llm.queries import (
    MIX_SEED,
    MIX_SHARE,
    MIX_WEIGHTS,
    PATTERN,
    PRIVATE_KEY,
    RANKS,
    domain_of,
    language_network,
)

#: a text whose best language has a smaller share is in none of the known languages
LEAST_SHARE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters or without a likely language; fills a missing language.

    Where no row has a language to learn from, every text with a letter stays.
    """
    return language_cnn.keep_known(docs, language_network(docs), LEAST_SHARE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that of the smallest id; rows without id stay.

    Rows that repeat an id come down to one, the smallest by its columns in their order.
    """
    classes = store(ngram_join.near_classes(docs))
    gone = store(classes.filter("doc_id <> component_id").select("doc_id").distinct())
    repeated = store(classes.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    few = gone.count() <= ngram_join.BROADCAST_ROWS
    kept = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(docs.columns)
    if not repeated.limit(1).count():
        return kept
    once = kept.join(repeated, "doc_id", "left_anti")
    smallest = F.min(F.struct(*docs.columns)).alias("row")
    twice = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(smallest).select("row.*")
    return once.unionByName(twice).select(docs.columns)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(docs, PRIVATE_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.select(docs, MIX_SHARE, MIX_WEIGHTS, domain_of(F.col("source")), MIX_SEED)
    return taken.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: ids of the whole text in place of the text."""
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS, PATTERN)
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("private", hide_private),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: the stages train a network and follow links, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        docs = store(made) if number < len(STAGES) - 1 else made
    return docs
