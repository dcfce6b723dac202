"""Periodic runs of words inside a document, and texts without their repetitions.

Method: internal pattern matching. All blocks of 2^k words at multiples of 2^k ask where they occur next, to the right and
to the left. A block is an interval of the suffix array (its words compared by prefix doubling), and the answer is a range
successor in a wavelet matrix over that array. An occurrence nearer than the block is long overlaps it, so the two begin an
arithmetic progression whose difference is a candidate period; it is extended to both sides by comparing ranks.

A run of period q and at least 4 q words is always found: with q < 2^k <= 2 q it holds an aligned block that can be
moved by q to one side within the run, and there no nearer occurrence exists. The work is a map over documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.llm.substring import joined
from skygalley.llm.words import slices, words_of

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass
class Suffixes:
    """Suffix array of a sequence, and for each k the first place in it of the class of 2^k symbols from each position."""

    array: np.ndarray
    ranks: list[np.ndarray]
    sizes: list[np.ndarray]  # how many positions share the class

    @classmethod
    def of(cls, symbols: np.ndarray) -> Suffixes:
        """The last symbol must be unique, so that no class runs over the end."""
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank, size = _classes(symbols[order], order, np.zeros(n, np.int64))
        ranks, sizes, width = [rank], [size], 1
        while True:
            shared = np.flatnonzero(size > 1)
            if not len(shared):
                return cls(order, ranks, sizes)
            # positions in a class of one stay where they are; the others are sorted within their class
            rank, size = rank.copy(), size.copy()
            key = rank[shared].astype(np.int64) * n + rank[shared + width]
            by_key = np.argsort(key, kind="stable")
            moved = shared[by_key]
            place = np.sort(rank[shared].astype(np.int64), kind="stable")
            begins = np.concatenate(([True], place[1:] != place[:-1]))
            first = np.flatnonzero(begins)
            within = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
            order[place + within] = moved
            rank[moved], size[moved] = _classes(key[by_key], None, place, within)
            ranks.append(rank)
            sizes.append(size)
            width *= 2


def _classes(key: np.ndarray, order: np.ndarray | None, place: np.ndarray, within: np.ndarray | None = None):
    """Class (its first place) and class size for ascending keys; by position if ``order`` is given."""
    n = len(key)
    first = np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), key[1:] != key[:-1])))
    length = np.diff(np.append(first, n))
    start = first if within is None else (place + within)[first]
    rank, size = np.repeat(start, length).astype(np.int32), np.repeat(length, length).astype(np.int32)
    if order is None:
        return rank, size
    by_position = np.empty(n, np.int32), np.empty(n, np.int32)
    by_position[0][order], by_position[1][order] = rank, size
    return by_position


class WaveletMatrix:
    """Counts and order statistics of any interval of a sequence of small numbers."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(one))).astype(np.int32))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            high = one.astype(bool)
            values = np.concatenate((values[~high], values[high]))

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are below the bound (itself below 2^bits)."""
        found = np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            a, b = self.ones[level][low], self.ones[level][high]
            up = (bound >> bit) & 1 == 1
            found += np.where(up, (high - low) - (b - a), 0)
            low = np.where(up, self.zeros[level] + a, low - a)
            high = np.where(up, self.zeros[level] + b, high - b)
        return found

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of [low, high)."""
        found = np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            a, b = self.ones[level][low], self.ones[level][high]
            zeros = (high - low) - (b - a)
            up = k >= zeros
            found += up.astype(np.int64) << bit
            k = np.where(up, k - zeros, k)
            low = np.where(up, self.zeros[level] + a, low - a)
            high = np.where(up, self.zeros[level] + b, high - b)
        return found


def _candidates(found: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(first position, difference): two occurrences of a block that overlap, nearest to each other."""
    n = len(found.array)
    at, gap = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    tree = WaveletMatrix(found.array)
    for k in range(1, len(found.ranks)):
        width = 1 << k
        block = np.arange(0, n, width)
        block = block[found.sizes[k][block] > 1]
        if not len(block):
            continue
        low = found.ranks[k][block].astype(np.int64)
        high = low + found.sizes[k][block]
        before = tree.below(low, high, block)
        for kth, side in ((before + 1, 1), (before - 1, -1)):
            some = np.flatnonzero((kth >= 0) & (kth < high - low))
            other = tree.kth(low[some], high[some], kth[some])
            distance = side * (other - block[some])
            near = distance < width
            at.append(np.minimum(block[some], other)[near])
            gap.append(distance[near])
    return np.concatenate(at), np.concatenate(gap)


def _extend(found: Suffixes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the sequence agrees from a and b on, and how far before them."""
    right, left = a.copy(), a.copy()
    gap = b - a
    for k in range(len(found.ranks) - 1, -1, -1):
        rank, width = found.ranks[k], 1 << k
        right += np.where(rank[right] == rank[right + gap], width, 0)
        back = np.maximum(left - width, 0)
        left = np.where((left >= width) & (rank[back] == rank[back + gap]), back, left)
    return right - a, a - left


def find_runs(symbols: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs, by start and period; the last symbol must be unique."""
    found = Suffixes.of(symbols)
    at, gap = _candidates(found)
    right, left = _extend(found, at, at + gap)
    start, length = at - left, left + gap + right
    long = length >= np.maximum(least, times * gap)
    runs = np.unique(np.stack((start[long], gap[long], length[long]), axis=1), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def collapse_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = 6,
    times: int = 4,
    carry: list[str] = (),
) -> DataFrame:
    """Per row: doc_id, n_words, runs, kept_text, and ``carry``.

    A run is a stretch of words with smallest period q, of at least ``least`` and ``times`` q words, that no word beside it
    extends; ``runs`` has (start, length, period) by start, then period. A word goes from ``kept_text`` if any run
    contains it after its first q words; the rest is joined by single spaces. Words are what stands between space and
    0x09-0x0D, unchanged, and are compared by 64-bit hashes.

    Null and empty texts have no words, no runs and an empty ``kept_text``. Every row is handled by itself, so repeated
    rows and ids give repeated results, and null ids stay. Other columns are ignored. A text is held in memory
    with some 200 bytes for each of its words.
    """
    if times < 4:
        raise ValueError("a run must hold its period four times or more")

    names = ["doc_id", "n_words", "runs", "kept_text", *[f"c{i}" for i in range(len(carry))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                n_words, runs, kept = _collapse(data, offsets, least, times)
                part = batch.slice(a, b - a)
                columns = [part.column(0), n_words, runs, kept, *part.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    kinds = [f", c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry)]
    out = rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, kept_text string" + "".join(kinds))
    return out.select("doc_id", "n_words", "runs", "kept_text", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])


def _collapse(data: np.ndarray, offsets: np.ndarray, least: int, times: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    w = words_of(data, offsets)
    texts, n = len(w.first) - 1, len(w.hash)
    # A symbol of its own ends every text, so nothing reaches over two texts; word i of text t is symbol i + t.
    _, word = np.unique(w.hash, return_inverse=True)
    symbols = np.empty(n + texts, np.int64)
    symbols[np.arange(n) + w.text] = word
    symbols[w.first[1:] + np.arange(texts)] = n + np.arange(texts)
    start, length, period = find_runs(symbols, least, times)
    begin = w.first[:-1] + np.arange(texts)
    text = np.searchsorted(begin, start, side="right") - 1
    first_word = start - text
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first_word + period, 1)
    np.subtract.at(edge, first_word + length, 1)
    kept = joined(w, np.cumsum(edge[:-1]) == 0)
    bounds = np.zeros(texts + 1, np.int32)
    np.cumsum(np.bincount(text, minlength=texts), out=bounds[1:])
    runs = pa.StructArray.from_arrays(
        [pa.array(v.astype(np.int64)) for v in (start - begin[text], length, period)], fields=list(_RUN_TYPE)
    )
    return pa.array(np.diff(w.first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), runs), kept
