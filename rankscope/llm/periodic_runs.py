"""Periodic runs of words by internal pattern matching.

The words of some texts, each text closed by a mark of its own, form one sequence. Its suffix array comes
from prefix doubling, which also names every stretch of 2^k words (the dictionary of basic factors). A
wavelet matrix over the suffix array answers range successor: the next occurrence of a basic factor from a
place on, from the interval that the factor has in the suffix array.

A run has a period q and at least ``max(LEAST_LENGTH, 3 q)`` words. With B the largest power of two up to q,
and 8 at least, it holds a block of B words that starts at a multiple of B and occurs again q words later. So
every block looks for its occurrences in two windows:

* up to B words later, for B = 8 only. Block and occurrence overlap, so only the next occurrence counts.
* B to 2 B - 1 words later. The occurrences form one progression. One or two of them are candidates as
  they are. With three or more the block has the progression's difference as a period: block and occurrences
  lie in two stretches with that period, and q takes the start of one to the start of the other, or the end to
  the end. (Where both are one stretch the block is within a run of the smaller period, found there.)

Each candidate is extended to both sides by comparing basic factors. What is long enough is a run; of equal
stretches the smallest period counts. Every run is found this way, and nothing else is reported.

Defined: a NULL or empty text has no words and no runs. Words are split at ASCII white space only. Texts of any
length are worked on whole: texts are joined up to ``TOGETHER`` words, one longer text alone. Ties follow
the contract of each result. Repeated rows have equal results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankscope.llm.common import strings

LEAST_LENGTH = 24
LEAST_BLOCK = 8
#: words that are worked on in one go
TOGETHER = 200_000

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Wavelet:
    """A wavelet matrix: order statistics of any interval of a sequence of numbers below ``2 ** bits``."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in range(bits - 1, -1, -1):
            flags = (values >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(flags)]).astype(np.int32))
            self.zeros.append(int(len(values) - flags.sum()))
            values = np.concatenate([values[flags == 0], values[flags == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of each interval ``[low, high)`` are less than ``bound``."""
        low, high = low.copy(), high.copy()
        found = np.zeros(len(low), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = (bound >> (self.bits - 1 - level)) & 1 == 1
            a, b = ones[low], ones[high]
            found += np.where(up, (high - b) - (low - a), 0)
            low, high = np.where(up, zeros + a, low - a), np.where(up, zeros + b, high - b)
        # a bound beyond all numbers
        return np.where(bound >> self.bits > 0, -1, found)

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number with ``rank`` smaller ones in each interval."""
        low, high, rank = low.copy(), high.copy(), rank.copy()
        value = np.zeros(len(low), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            a, b = ones[low], ones[high]
            few = (high - b) - (low - a)
            up = rank >= few
            rank -= np.where(up, few, 0)
            value += up.astype(np.int64) << (self.bits - 1 - level)
            low, high = np.where(up, zeros + a, low - a), np.where(up, zeros + b, high - b)
        return value


class Factors:
    """Names of all stretches of 2^k words, and the suffix array, of a sequence whose suffixes all differ.

    ``names[k][i]`` is the place in the suffix array of the first suffix that begins like suffix ``i`` does in
    its first 2^k words, so equal stretches have equal names. Beyond the last level no stretch repeats.
    """

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        order = np.argsort(words, kind="stable")
        name = _first_places(words[order], order, n)
        self.names = [name]
        self.order = order
        size = 1
        while True:
            # places whose stretch is not the only one of its name
            ordered = name[order]
            repeated = np.append(ordered[1:] == ordered[:-1], False)
            repeated[1:] |= repeated[:-1].copy()
            live = np.flatnonzero(repeated)
            if not len(live):
                break
            suffix = order[live]
            after = suffix + size
            follow = np.where(after < n, name[np.minimum(after, n - 1)], -1) + 1
            key = ordered[live].astype(np.int64) * (n + 1) + follow
            sort = np.argsort(key, kind="stable")
            order = order.copy()
            order[live] = suffix[sort]
            key = key[sort]
            fresh = np.append(True, key[1:] != key[:-1])
            name = name.copy()
            name[order[live]] = live[np.maximum.accumulate(np.where(fresh, np.arange(len(live)), 0))]
            self.names.append(name)
            self.order = order
            size *= 2

    def equal_after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from ``x`` and from ``y`` on are equal."""
        n, found = len(self.order), np.zeros(len(x), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, size = self.names[k], 1 << k
            while True:  # more than once only at the top
                a, b = x + found, y + found
                same = (np.maximum(a, b) < n) & (name[np.minimum(a, n - 1)] == name[np.minimum(b, n - 1)])
                found += np.where(same, size, 0)
                if k < len(self.names) - 1 or not same.any():
                    break
        return found

    def equal_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before ``x`` and before ``y`` are equal."""
        found = np.zeros(len(x), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, size = self.names[k], 1 << k
            while True:
                a, b = x - found - size, y - found - size
                same = (np.minimum(a, b) >= 0) & (name[np.maximum(a, 0)] == name[np.maximum(b, 0)])
                found += np.where(same, size, 0)
                if k < len(self.names) - 1 or not same.any():
                    break
        return found


def _first_places(ordered: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    name = np.empty(n, np.int64)
    name[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return name


@dataclass
class Runs:
    """Runs of a sequence by start, then period; ``start`` counts from the sequence's beginning."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _candidates(factors: Factors, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that a run may have there; ``ends`` is the end of each place's text."""
    n = len(factors.order)
    wavelet = Wavelet(factors.order.astype(np.int64), max(1, int(n - 1).bit_length()))
    places, periods = [], []
    for k in range(3, len(factors.names)):
        size = 1 << k
        name = factors.names[k]
        ordered = name[factors.order]
        # interval of each block's factor in the suffix array; factors that occur once ask nothing
        block = np.arange(0, n, size)
        low = name[block]
        several = (low + 1 < n) & (ordered[np.minimum(low + 1, n - 1)] == low)
        block, low = block[several], low[several]
        if not len(block):
            continue
        high = np.searchsorted(ordered, low, side="right")
        if size == LEAST_BLOCK:
            at = _next(wavelet, low, high, block + 1, np.minimum(block + size, ends[block] - 1))
            places.append(block[at >= 0])
            periods.append((at - block)[at >= 0])
        last = np.minimum(block + 2 * size - 1, ends[block] - 1)
        one = _next(wavelet, low, high, block + size, last)
        found = one >= 0
        block, low, high, last, one = (x[found] for x in (block, low, high, last, one))
        two = _next(wavelet, low, high, one + 1, last)
        three = np.where(two >= 0, _next(wavelet, low, high, np.maximum(two, 0) + 1, last), -1)
        few = three < 0
        places += [block[few], block[few & (two >= 0)]]
        periods += [(one - block)[few], (two - block)[few & (two >= 0)]]
        block, one, step = block[~few], one[~few], (two - one)[~few]
        if len(block):
            begins = [x - factors.equal_before(x, x + step) for x in (block, one)]
            closes = [x + factors.equal_after(x, x + step) for x in (block, one)]
            apart = begins[0] != begins[1]
            for first, second in (begins, closes):
                period = second - first
                good = apart & (period >= size) & (period < 2 * size)
                places.append(block[good])
                periods.append(period[good])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _next(wavelet: Wavelet, low: np.ndarray, high: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The first occurrence from ``start`` to ``last`` among those in the interval, or -1."""
    before = wavelet.below(low, high, start)
    some = (before >= 0) & (before < high - low) & (start <= last)
    out = np.full(len(low), -1, np.int64)
    out[some] = wavelet.smallest(low[some], high[some], before[some])
    return np.where(out <= last, out, -1)


def find_runs(words: np.ndarray, lengths: np.ndarray) -> tuple[Runs, np.ndarray]:
    """The runs of texts of ``lengths`` words, laid end to end in ``words`` with numbers from 0 for words.

    Returns them with the text of each; starts count from the text's own beginning.
    """
    count = len(lengths)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    n = int(starts[-1])
    text = np.repeat(np.arange(count), lengths + 1)
    sequence = np.empty(n, np.int64)
    closes = starts[1:] - 1
    inside = np.ones(n, bool)
    inside[closes] = False
    sequence[inside] = words
    sequence[closes] = int(words.max(initial=-1)) + 1 + np.arange(count)  # each mark occurs once
    none = np.zeros(0, np.int64)
    if n <= LEAST_LENGTH:
        return Runs(none, none, none), none
    factors = Factors(sequence)
    place, period = _candidates(factors, closes[text])
    if not len(place):
        return Runs(none, none, none), none
    back = factors.equal_before(place, place + period)
    length = back + factors.equal_after(place, place + period) + period
    start = place - back
    long = length >= np.maximum(LEAST_LENGTH, 3 * period)
    found = np.unique(np.stack([start[long], length[long], period[long]]), axis=1)
    if found.size:
        # equal stretches stand together, the smallest period first
        found = found[:, np.append(True, (found[:2, 1:] != found[:2, :-1]).any(axis=0))]
    found = found[:, np.lexsort((found[2], found[0]))]
    owner = text[found[0]] if found.size else none
    return Runs(found[0] - starts[owner], found[1], found[2]), owner


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words of the contract: a tenth of the texts repeat a stretch from a place on that the id tells."""
    if doc_id is None or not words:
        return words
    crc = zlib.crc32(str(doc_id).encode())
    if crc % 10:
        return words
    n, g = len(words), crc // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    stretch = words[start : start + period]
    return words[:start] + (stretch * (-(-(n - start) // period)))[: n - start]


def _groups(sizes: list[int]) -> Iterator[slice]:
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > TOGETHER:
            yield slice(first, i)
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def runs_of_texts(texts: list[list[str]]) -> list[Runs]:
    """The runs of each list of words."""
    out: list[Runs] = []
    for part in _groups([len(t) + 1 for t in texts]):
        group = texts[part]
        known: dict[str, int] = {}
        coded = np.array([known.setdefault(w, len(known)) for t in group for w in t], np.int64)
        runs, owner = find_runs(coded, np.array([len(t) for t in group], np.int64))
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(group) + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[a:b]
            out.append(Runs(runs.start[at], runs.length[at], runs.period[at]))
    return out


def collapse(words: list[str], runs: Runs) -> list[str]:
    """The words that no run holds behind its first period."""
    if not len(runs.start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


_OUT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _row(words: list[str], runs: Runs) -> tuple:
    rows = list(zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
    best: tuple = (None, None, None)
    for row in rows:  # by start, then period: the first of equals stays
        if best[0] is None or row[1] * best[2] > best[1] * row[2]:
            best = row
    power = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(rows), *best, power, _digest(lines), _digest(" ".join(collapse(words, runs))))


def report(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per row: ``doc_id``, its runs in short, and the digests of the runs and of the text without repeats.

    With ``plant`` a tenth of the texts first get a repeated stretch, as the registered query wants.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), strings(batch, "text")
            sizes = [1 + len(t) // 6 for t in texts]
            for part in _groups(sizes):
                words = [WORD.findall(t) for t in texts[part]]
                if plant:
                    words = [planted(w, i) for w, i in zip(words, ids[part], strict=True)]
                rows = [_row(w, r) for w, r in zip(words, runs_of_texts(words), strict=True)]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[part.start : part.stop], *columns], names)

    names = ["doc_id", *(c.split()[0] for c in _OUT.split(", "))]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_OUT}")
