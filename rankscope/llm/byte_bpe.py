"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A text is split by the vocabulary's pattern. Each distinct piece of a task becomes a row of a numpy
matrix with the rows of about its length; in each round every row merges its leftmost pair of lowest
rank, found in a hash table of pairs, and rows without a pair leave the matrix. Pieces longer than
the widest matrix (unbroken runs of letters, encoded binary) go through a heap by the same rule, in
``n log n`` steps.

NULL and empty texts give no ids. Repeated rows, ties, extra columns and empty tables need no care: each
row is encoded by itself and only the named columns are read.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rankscope.llm.common import cut, released, slices, strings

NO_PAIR = np.int32(2**31 - 1)
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024)
CELLS = 1 << 18
#: words whose ids are remembered, about 400 bytes each
REMEMBERED = 100_000
#: characters of texts that are encoded in one go, and UTF-8 bytes of texts whose ids are handed on in one batch
TOGETHER = 1_000_000
BLANK_AFTER_SPACE = re.compile(r" (?:\s|$)").search


class PairTable:
    """An open-addressing hash table from pairs of token ids to the id of the merged token."""

    EMPTY = np.int64(-(2**62))

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(4 * max(1, len(left))))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, self.EMPTY)
        self.values = np.zeros(1 << bits, np.int32)
        keys = self._key(left, right)
        slots = self._home(keys)
        self.probes = 0
        while len(keys):
            free = self.keys[slots] == self.EMPTY
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = merged[placed]
            keys, merged = keys[~placed], merged[~placed]
            slots = (slots[~placed] + 1) & self.mask
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, ``NO_PAIR`` where there is none. Ids below 0 are padding."""
        keys = self._key(left, right)
        slots = self._home(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.values[slots], NO_PAIR)
        open_ = np.nonzero((held != keys) & (held != self.EMPTY))[0]
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & self.mask
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (held != self.EMPTY)]
        return found


class Vocabulary:
    """Ranks of one vocabulary file. A token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            rows = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        sizes = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for token, rank in self.ranks.items():
            sizes[rank] = len(token)
        self.token_sizes, self.token_starts = sizes, np.cumsum(sizes) - sizes
        self.token_bytes = np.frombuffer(b"".join(sorted(self.ranks, key=self.ranks.get)), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs: dict[tuple[int, int], int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        ends = np.array(list(self.pairs), np.int64).reshape(-1, 2)
        self.table = PairTable(ends[:, 0], ends[:, 1], np.array(list(self.pairs.values()), np.int32))

    def merge_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all rows of a matrix padded with -1 at the right. Returns it with row lengths."""
        count, width = ids.shape
        done = np.full((count, width), -1, np.int32)
        lengths = np.zeros(count, np.int64)
        rows = np.arange(count)
        best = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(count, -1)
        while len(rows):
            every = np.arange(len(rows))
            if best.shape[1]:
                at = best.argmin(axis=1)
                rank = best[every, at]
                ended = rank == NO_PAIR
            else:
                ended = np.ones(len(rows), bool)
            if ended.any():
                done[rows[ended], : ids.shape[1]] = ids[ended]
                lengths[rows[ended]] = (ids[ended] >= 0).sum(axis=1)
                live = ~ended
                rows, ids, best = rows[live], ids[live], best[live]
                if not len(rows):
                    break
                at, rank, every = at[live], rank[live], np.arange(len(rows))
            ids[every, at] = rank
            columns = np.arange(ids.shape[1])
            ids = ids[columns != at[:, None] + 1].reshape(len(rows), -1)
            best = best[columns[:-1] != at[:, None]].reshape(len(rows), -1)
            for place in (at - 1, at):
                inside = np.nonzero((place >= 0) & (place < best.shape[1]))[0]
                here = place[inside]
                best[inside, here] = self.table.find(ids[inside, here], ids[inside, here + 1])
        return done, lengths

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one very long piece, with a heap over a linked list."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < size:
                rank = self.pairs.get((ids[i], ids[after[i]]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        for i in range(size - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= size or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        bucket = np.searchsorted(WIDTHS, sizes)
        lengths = np.zeros(len(pieces), np.int64)
        parts: list[np.ndarray] = []
        order: list[np.ndarray] = []
        for i in np.nonzero(bucket == len(WIDTHS))[0]:
            parts.append(np.array(self.merge_long(pieces[i]), np.int32))
            order.append(np.array([i]))
            lengths[i] = len(parts[-1])
        for b, width in enumerate(WIDTHS):
            members = np.nonzero(bucket == b)[0]
            step = max(1, CELLS // width)
            for chunk in (members[i : i + step] for i in range(0, len(members), step)):
                raw = b"".join([pieces[i].ljust(width, b"\0") for i in chunk.tolist()])
                ids = self.of_byte[np.frombuffer(raw, np.uint8)].reshape(len(chunk), width)
                ids[np.arange(width) >= sizes[chunk][:, None]] = -1
                merged, lengths[chunk] = self.merge_rows(ids)
                parts.append(merged[merged >= 0])
                order.append(chunk)
        if not pieces:
            return np.empty(0, np.int32), lengths
        flat, done = np.concatenate(parts), np.concatenate(order)
        starts = np.empty(len(pieces), np.int64)
        starts[done] = np.cumsum(lengths[done]) - lengths[done]
        return spans(flat, starts, lengths), lengths


def spans(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The named spans of ``flat`` one after another."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return flat[np.repeat(shift, lengths) + np.arange(lengths.sum())]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Fresh:
    """Strings in the order in which they were first seen; only those since the last ``take`` are held."""

    def __init__(self) -> None:
        self.taken, self.waiting = 0, []

    def __len__(self) -> int:
        return self.taken + len(self.waiting)

    def add(self, string: str) -> int:
        self.waiting.append(string)
        return self.taken + len(self.waiting) - 1

    def take(self) -> list[str]:
        taken, self.waiting = self.waiting, []
        self.taken += len(taken)
        return taken


class _Numbers(dict):
    """Numbers strings in the order in which they first appear; several may share one order."""

    def __init__(self, order: _Fresh, prefix: str = ""):
        super().__init__()
        self.order, self.prefix = order, prefix

    def __missing__(self, piece: str) -> int:
        self[piece] = number = self.order.add(self.prefix + piece)
        return number


class _Spans:
    """Ids of numbered strings, kept one after another."""

    def __init__(self) -> None:
        self.flat, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.ends[numbers]
        lengths = self.ends[numbers + 1] - starts
        return spans(self.flat, starts, lengths), lengths


def _lists(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in rows], np.int64)
    return np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum())), sizes


def _totals(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of ``values``."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


class Encoder:
    """Encodes texts batch by batch, remembering the ids of up to ``REMEMBERED`` words.

    A space that is followed by something else than white space always begins a match of the
    pattern, so such a text is cut at its spaces and each distinct word is split and merged once.
    Other texts are split by the pattern as a whole.
    """

    def __init__(self, path: str, pattern: str):
        self.vocabulary = vocabulary(path)
        # the tokenizer's white space is the Unicode property
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self._forget()

    def _forget(self) -> None:
        self.words = _Fresh()
        self.plain, self.spaced = _Numbers(self.words), _Numbers(self.words, " ")
        self.word_ids = _Spans()
        self.pieces = _Fresh()
        self.piece = _Numbers(self.pieces)
        self.piece_ids = _Spans()

    def _numbers(self, text: str) -> list[int]:
        if BLANK_AFTER_SPACE(text):
            return list(map(self.plain.__getitem__, self.split(text)))
        first, *rest = text.split(" ")
        return [self.plain[first], *map(self.spaced.__getitem__, rest)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids begin (one more at the end)."""
        parts, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for part in slices(texts, TOGETHER):
            ids, counts = self._encode_some(texts[part])
            parts.append(ids)
            sizes.append(counts)
        return np.concatenate(parts), np.cumsum(np.concatenate(sizes))

    def _encode_some(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if len(self.words) > REMEMBERED:
            self._forget()
        used, words_in = _lists([self._numbers(t) for t in texts])
        if fresh := self.words.take():
            number = self.piece.__getitem__
            parts, parts_in = _lists([list(map(number, self.split(w))) for w in fresh])
            new = [p.encode("utf-8", "surrogatepass") for p in self.pieces.take()]
            self.piece_ids.add(*self.vocabulary.encode_pieces(new))
            ids, sizes = self.piece_ids.take(parts)
            self.word_ids.add(ids, _totals(sizes, parts_in))
        ids, sizes = self.word_ids.take(used)
        return ids, _totals(sizes, words_in)


def decode_ids(path: str, ids: np.ndarray) -> bytes:
    """The bytes that the ids stand for."""
    v = vocabulary(path)
    return spans(v.token_bytes, v.token_starts[ids], v.token_sizes[ids]).tobytes()


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with its text encoded in column ``ids`` (array of int); a column of that name goes.

    All other columns pass unchanged. ``path`` must exist on every executor.
    """
    kept = docs.drop(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for part in cut(batches, text, TOGETHER):
            flat, bounds = encoder.encode(strings(part, text))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, ids])

    return kept.mapInArrow(released(run), schema)


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes of its ids in column ``out``; NULL ids give no bytes."""
    kept = tokens.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(ids).to_pylist()
            made = pa.array([decode_ids(path, np.array(x or [], np.int64)) for x in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, out])

    return kept.mapInArrow(run, schema)
