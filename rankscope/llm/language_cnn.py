"""Language identification by a small convolutional network over bytes.

Training: windows of ``WINDOW`` bytes at hashed places of labelled texts, a bounded number for each
language, go to the driver, which trains the network in numpy. Prediction: each whole text is cut into
windows; bytes are embedded, filters of several widths slide over them, each keeps its largest answer
in the window, and a softmax gives the languages' shares. A text's score for a language is the mean share
over its windows, weighted by their bytes.

A text that is NULL, empty or without a letter gets ``und`` with score 0. Rows without text or language
teach nothing; with no labelled row every text is ``und``. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankscope.llm.common import cut, released, slices

WINDOW = 256
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 8
WIDEST = max(WIDTHS)
CHUNK = 64
#: characters of texts that are scored in one go
TOGETHER = 2_000_000

_LETTER = re.compile(r"[^\W\d_]").search


@dataclass
class Network:
    """``embed`` has a row for each byte and one for padding; ``filters`` all widths side by side."""

    labels: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(labels: list[str], seed: int) -> Network:
        rng = np.random.default_rng(seed)
        embed = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
        embed[256] = 0
        filters = rng.normal(0, 0.3, (WIDEST * EMBED, len(WIDTHS) * FILTERS)).astype(np.float32)
        out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        net = Network(labels, embed, filters * Network.shape(), np.zeros(filters.shape[1], np.float32),
                      out, np.zeros(len(labels), np.float32))
        return net

    @staticmethod
    def shape() -> np.ndarray:
        """1 where a filter of its width has a weight."""
        mask = np.zeros((WIDEST * EMBED, len(WIDTHS) * FILTERS), np.float32)
        for i, width in enumerate(WIDTHS):
            mask[: width * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
        return mask

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Each position with the bytes after it, embedded: (rows, positions, WIDEST * EMBED)."""
        places = windows.shape[1] - WIDEST + 1
        vectors = self.embed[windows]
        return np.concatenate([vectors[:, k : k + places] for k in range(WIDEST)], axis=2)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """The largest answer of each filter in each window, not below 0."""
        found = self.columns(windows)
        answers = found.reshape(-1, found.shape[2]) @ self.filters
        most = answers.reshape(len(windows), -1, answers.shape[1]).max(axis=1)
        return np.maximum(most + self.bias, 0)

    def shares(self, windows: np.ndarray) -> np.ndarray:
        parts = [
            _softmax(self.pooled(windows[i : i + CHUNK]) @ self.out + self.out_bias)
            for i in range(0, len(windows), CHUNK)
        ]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)))


def _softmax(x: np.ndarray) -> np.ndarray:
    powers = np.exp(x - x.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def to_windows(raw: bytes) -> np.ndarray:
    """A text's bytes in rows of ``WINDOW``, the last filled with 256."""
    count = max(1, -(-len(raw) // WINDOW))
    out = np.full(count * WINDOW, 256, np.int16)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(count, WINDOW)


def train(windows: np.ndarray, labels: np.ndarray, names: list[str], epochs: int = 8, seed: int = 7) -> Network:
    """Fit by Adam on cross entropy over shuffled batches."""
    net = Network.fresh(names, seed)
    mask = Network.shape()
    rng = np.random.default_rng(seed)
    params = ["embed", "filters", "bias", "out", "out_bias"]
    first = {p: np.zeros_like(getattr(net, p)) for p in params}
    second = {p: np.zeros_like(getattr(net, p)) for p in params}
    step = 0
    for epoch in range(epochs):
        rate = 0.02 / (1 + epoch)
        for chosen in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // CHUNK)):
            if not len(chosen):
                continue
            batch = windows[chosen]
            columns = net.columns(batch)
            n, places, _ = columns.shape
            answers = (columns.reshape(n * places, -1) @ net.filters).reshape(n, places, -1)
            at = answers.argmax(axis=1)
            raw = np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + net.bias
            pooled = np.maximum(raw, 0)
            error = _softmax(pooled @ net.out + net.out_bias)
            error[np.arange(n), labels[chosen]] -= 1
            error /= n
            back = (error @ net.out.T) * (raw > 0)
            best = columns[np.arange(n)[:, None], at]
            grads = {
                "out": pooled.T @ error,
                "out_bias": error.sum(axis=0),
                "bias": back.sum(axis=0),
                "filters": np.einsum("nf,nfd->df", back, best) * mask,
                "embed": np.zeros_like(net.embed),
            }
            to_bytes = (back[:, :, None] * net.filters.T[None]).reshape(n, -1, WIDEST, EMBED)
            for k in range(WIDEST):
                np.add.at(grads["embed"], batch[np.arange(n)[:, None], at + k], to_bytes[:, :, k])
            grads["embed"][256] = 0
            step += 1
            for p in params:
                g = grads[p]
                first[p] = 0.9 * first[p] + 0.1 * g
                second[p] = 0.999 * second[p] + 0.001 * g * g
                move = (first[p] / (1 - 0.9**step)) / (np.sqrt(second[p] / (1 - 0.999**step)) + 1e-8)
                setattr(net, p, (getattr(net, p) - rate * move).astype(np.float32))
    return net


def sample_windows(
    labelled: DataFrame, text: str, lang: str, order: Column, texts_per_language: int = 400,
    windows_per_text: int = 4,
) -> list[tuple[str, bytes]]:
    """Training windows: the texts of each language that come first by ``order``, a few windows each.

    At most ``texts_per_language`` texts of a language, however many rows there are; a window starts
    at an even distance in the text. The text is cut on the executors, so the driver gets windows.
    """
    # a share of each language somewhat above what is wanted, so that no language is sorted whole
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), order.alias("place")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    wanted = F.lit(False)
    for name, n in sorted(counts.items()):
        share = min(1.0, 2.0 * texts_per_language / n + 20 / n)
        wanted = wanted | ((F.col("lang") == name) & (F.col("place") < share))
    raw = F.encode("text", "utf-8")
    gap = F.greatest(F.lit(1), F.floor((F.length(raw) - WINDOW) / max(1, windows_per_text - 1)))
    cuts = F.transform(
        F.sequence(F.lit(0), F.lit(windows_per_text - 1)),
        lambda k: F.substring(raw, (1 + k * gap).cast("int"), F.lit(WINDOW)),
    )
    cut = rows.filter(wanted).select("lang", "place", F.array_distinct(cuts).alias("windows"))
    numbered = cut.selectExpr("*", "row_number() over (partition by lang order by place, windows) as n")
    return [
        (r["lang"], bytes(w))
        for r in numbered.filter(F.col("n") <= texts_per_language).orderBy("lang", "n").collect()
        for w in r["windows"]
        if len(w) >= 8
    ]


def fit(
    labelled: DataFrame, order: Column, text: str = "text", lang: str = "lang", **bounds: int
) -> Network | None:
    """A network trained on a bounded sample; ``order`` is a reproducible number from 0 to 1 per row."""
    found = sample_windows(labelled, text, lang, order, **bounds)
    if not found:
        return None
    names = sorted({lang for lang, _ in found})
    windows = np.concatenate([to_windows(w)[:1] for _, w in found])
    labels = np.array([names.index(lang) for lang, _ in found])
    return train(windows, labels, names)


def predict_texts(net: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of whole texts."""
    live = [i for i, t in enumerate(texts) if t and _LETTER(t)] if net else []
    out = [("und", 0.0)] * len(texts)
    for part in slices([texts[i] for i in live], TOGETHER):
        group = live[part]
        raw = [texts[i].encode("utf-8", "surrogatepass") for i in group]
        windows = [to_windows(r) for r in raw]
        shares = net.shares(np.concatenate(windows)).astype(np.float64)
        counts = np.array([len(w) for w in windows])
        ends = np.cumsum(counts)
        weight = np.full(ends[-1], float(WINDOW))
        sizes = np.array([len(r) for r in raw])
        weight[ends - 1] = sizes - (counts - 1) * WINDOW
        means = np.add.reduceat(shares * weight[:, None], ends - counts) / sizes[:, None]
        for i, row in zip(group, means, strict=True):
            best = int(row.argmax())
            out[i] = (net.labels[best], min(1.0, max(0.0, float(row[best]))))
    return out


def keep_known(docs: DataFrame, net: Network | None, least_share: float, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows whose text has a letter and a language with at least ``least_share``; a NULL ``lang`` is filled.

    One pass through Python decides and fills. With no network (nothing to learn from) every row with a letter
    stays, and ``lang`` as it is.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, text, TOGETHER):
            texts = batch.column(names.index(text)).to_pylist()
            if net is None:
                said = [(None, 1.0 if t and _LETTER(t) else -1.0) for t in texts]
            else:
                said = [(name, -1.0 if name == "und" else share) for name, share in predict_texts(net, texts)]
            keep = pa.array([share >= least_share for _, share in said], pa.bool_())
            filled = pc.coalesce(batch.column(names.index(lang)), pa.array([name for name, _ in said], pa.string()))
            columns = [filled if i == names.index(lang) else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(keep)

    return docs.mapInArrow(released(run), docs.schema)


def language(net: Network | None, text: Column) -> Column:
    """A struct of ``lang_pred`` and ``score`` for a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        values = [None if t is None or t != t else t for t in texts.tolist()]
        return pd.DataFrame(predict_texts(net, values), columns=["lang_pred", "score"])

    return predict(text)
