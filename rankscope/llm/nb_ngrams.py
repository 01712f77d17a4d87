"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct character n-grams of the whole lower-cased text, hashed into ``BUCKETS``
cells. Cells are counted over all labelled training rows, per class; a cell's scale is the log of its
smoothed share among rows of label 1 against that among rows of label 0. A logistic regression over the
scaled features, divided by the root of their number, is fitted on a bounded sample. Its weights times the
scales are one number for each cell, so a score is a sum over a text's cells and needs no shuffle.

Bounds: about ``per_class`` rows of each label fit the weights, none of more than ``sample_chars``
characters; counts are taken over all rows. A NULL text counts as empty; an empty text has the score of the
intercept. Texts of any length are read whole. Equal texts get equal scores. Where an id has several labels
the largest counts; labels other than 0 and 1, and rows without id, teach nothing; repeated rows of
``docs`` each count. Without training rows of both labels every score is the share of label 1 among them,
or 0 without any. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import store, strings

ORDERS = (3, 4, 5)
BUCKETS = 1 << 18
SMOOTHING = 1.0
PENALTY = 1e-3
STEPS = 60
RATE = 0.1


@dataclass
class Model:
    """``weights`` has the weight times the scale of each cell."""

    weights: np.ndarray
    intercept: float


class Grams:
    """The cells of a text; holds one flag for each cell, so that no text's n-grams are sorted."""

    def __init__(self) -> None:
        self.seen = np.zeros(BUCKETS, bool)

    def cells(self, text: str) -> np.ndarray:
        """The distinct cells of the n-grams of ``text``, rising."""
        if not text:
            return np.zeros(0, np.int64)
        # a space at either end marks the first and last word
        chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        mixed = chars * np.uint32(0x9E3779B1)
        state = np.zeros(len(chars), np.uint32)
        for size in range(1, max(ORDERS) + 1):
            left = len(chars) - size + 1
            if left <= 0:
                break
            state = (state[:left] * np.uint32(0x01000193)) ^ mixed[size - 1 :]
            if size in ORDERS:
                cell = state ^ (state >> np.uint32(15))
                cell *= np.uint32(0x85EBCA6B)
                self.seen[(cell ^ (cell >> np.uint32(13))) % np.uint32(BUCKETS)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


def labelled(docs: DataFrame, labels: DataFrame, trains: Column) -> DataFrame:
    """``(doc_id, text, label)`` of the rows of ``docs`` where ``trains`` holds and a label is known."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    rows = docs.filter(trains).filter("doc_id is not null").select("doc_id", "text")
    # one plan at every size: a table of labels that is broadcast while small would hide what a large one costs
    return rows.join(store(known).hint("merge"), "doc_id")


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold each cell (one line for each label), and the rows of each label.

    Every task adds up its rows first; the driver gets one row for each cell.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = Grams(), np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for text, label in zip(strings(batch, "text"), batch.column("label").to_pylist(), strict=True):
                held[label, grams.cells(text)] += 1
                held[label, BUCKETS] += 1  # the rows themselves
        used = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, *held[:, used])], ["cell", "clean", "toxic"])

    parts = rows.select("text", F.col("label").cast("int")).mapInArrow(count, "cell long, clean long, toxic long")
    sums = parts.groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    held = np.zeros((2, BUCKETS + 1), np.int64)
    held[:, sums.column("cell").to_numpy()] = [sums.column(c).to_numpy() for c in ("clean", "toxic")]
    return held[:, :BUCKETS], held[:, BUCKETS]


def log_ratios(held: np.ndarray) -> np.ndarray:
    shares = held + SMOOTHING
    clean, toxic = shares / shares.sum(axis=1, keepdims=True)
    return np.log(toxic / clean)


def sample_cells(rows: DataFrame, totals: np.ndarray, per_class: int, sample_chars: int) -> list[tuple[int, np.ndarray]]:
    """The cells of about ``per_class`` rows of each label, chosen by a hash of id and text."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    clean, toxic = (float(per_class) / max(1, int(n)) for n in totals)
    chosen = rows.filter(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars).filter(
        place < F.when(F.col("label") == 1, toxic).otherwise(clean)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            cells = [grams.cells(text).astype("<u4").tobytes() for text in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(cells, pa.binary())], ["label", "cells"])

    # the limit holds where one id and text repeat so often that the hash cannot thin them
    found = chosen.select("text", F.col("label").cast("int")).mapInArrow(cut, "label int, cells binary")
    table = found.limit(4 * per_class).toArrow()
    pairs = zip(table.column("label").to_pylist(), table.column("cells").to_pylist(), strict=True)
    return [(label, np.frombuffer(cells, "<u4").astype(np.int32)) for label, cells in sorted(pairs)]


def regress(sample: list[tuple[int, np.ndarray]], scales: np.ndarray) -> Model:
    """Logistic regression by Adam; both labels weigh the same however many rows they have."""
    sizes = np.array([len(cells) for _, cells in sample])
    truth = np.array([label for label, _ in sample], np.float64)
    cells = np.concatenate([c for _, c in sample])
    row = np.repeat(np.arange(len(sample), dtype=np.int32), sizes)
    values = (scales[cells] / np.sqrt(np.maximum(sizes, 1))[row]).astype(np.float32)
    share = np.where(truth == 1, 0.5 / max(1, truth.sum()), 0.5 / max(1, (1 - truth).sum()))
    weights = np.zeros(BUCKETS + 1)  # the last is the intercept
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        sums = np.bincount(row, weights[cells] * values, len(sample)) + weights[-1]
        error = (_logistic(sums) - truth) * share
        slope = np.append(np.bincount(cells, error[row] * values, BUCKETS) + PENALTY * weights[:-1], error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights -= RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model((weights[:-1] * scales).astype(np.float32), float(weights[-1]))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: DataFrame, per_class: int = 1000, sample_chars: int = 10_000) -> Model | float:
    """The model of ``(doc_id, text, label)`` rows, or the share of label 1 where a label is missing."""
    rows = store(rows)
    held, totals = class_counts(rows)
    share = float(totals[1] / max(1, totals.sum()))
    if not totals.all():
        return share
    sample = sample_cells(rows, totals, per_class, sample_chars)
    if len({label for label, _ in sample}) < 2:  # all rows of a label are longer than a sample takes
        return share
    return regress(sample, log_ratios(held))


def score_texts(model: Model | float, texts: list[str], grams: Grams) -> np.ndarray:
    if not isinstance(model, Model):
        return np.full(len(texts), model)
    sums = np.empty(len(texts))
    for i, text in enumerate(texts):
        cells = grams.cells(text)
        sums[i] = model.weights[cells].sum(dtype=np.float64) / np.sqrt(max(1, len(cells)))
    return _logistic(sums + model.intercept)


def score(docs: DataFrame, model: Model | float, held_out: Column) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            scores = score_texts(model, strings(batch, "text"), grams)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
