"""Best-fit packing of token pieces into sequences of a fixed length.

Method: exact-complement hashing over length counts. For the longest length left, the gap it leaves is
looked up among the lengths themselves, the sums of two and the sums of three; a combination that fills the gap exactly
is used as often as the counts allow. A gap without an exact complement takes the best fit, the longest piece that it
holds, and what then remains is looked up again. Only the number of pieces of each length matters, so the plan is made
from at most ``size`` counts whatever the number of documents is, and Spark then places every piece by its rank within its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize
from skygalley.llm.tokens import read_json, spaced_encoder
from skygalley.llm.words import slices

SIZE = 1024
BATCH_BYTES = 1 << 20
_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids binary"
)
_PLACED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
    "sequence_id long, offset long"
)


class _Complements:
    """Pieces left by length, and an index of the sums that one, two and three of them can have.

    Pieces only ever get fewer, so an index made earlier says no rightly; a yes is looked up, and when it proves wrong
    the index is made anew. Pairs and triples leave ``spare`` pieces of each length alone.
    """

    def __init__(self, left: list[int], spare: int):
        self.left = left
        self.spare = spare
        self._make()

    def _make(self) -> None:
        self.single = np.array(self.left) > self.spare
        self.single[0] = False
        size, one = len(self.left), self.single.astype(np.float32)
        self.pair = np.convolve(one, one)[:size] > 0.5
        self.triple = np.convolve(self.pair.astype(np.float32), one)[:size] > 0.5

    def _pair(self, total: int, least: int = 1) -> tuple[int, int] | None:
        """The longest length with its complement, which has ``least`` ids or more."""
        left, spare = self.left, self.spare
        for y in range(least, total // 2 + 1):
            x = total - y
            if left[x] > spare and left[y] > spare + (x == y):
                return x, y
        return None

    def find(self, gap: int) -> tuple[int, ...] | None:
        """Up to three lengths whose sum is the gap, longest first; the fewest that do."""
        if self.left[gap]:
            return (gap,)
        if self.pair[gap] and (found := self._pair(gap)):
            return found
        if not self.triple[gap]:
            return None
        for a in range(1, gap // 3 + 1):
            if self.left[a] > self.spare and self.pair[gap - a]:
                self.left[a] -= 1
                rest = self._pair(gap - a, a)
                self.left[a] += 1
                if rest:
                    return (*rest, a)
        self._make()
        return None

    def largest(self, gap: int) -> int:
        """The longest length left that the gap holds; 0 for none."""
        while gap and not self.left[gap]:
            gap -= 1
        return gap


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), using each length as often as counted.

    Where lengths are rare, pairs and triples that take the last piece of one cost more than they fill: the plan is made
    with and without one spare piece of each length, and the one with fewer sequences is taken, of equal ones the first.
    """
    return min((_plan(counts, size, spare) for spare in (0, 1)), key=lambda shapes: sum(n for _, n in shapes))


def _plan(counts: dict[int, int], size: int, spare: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest piece first. Its gap is filled by an exact complement; where there is none, the best fit, the longest
    piece that the gap holds, goes in, and the smaller gap is looked up again. The sequence so found is made as often
    as the counts allow."""
    left = [0] * (size + 1)
    for length, n in counts.items():
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} does not fit")
        left[length] += n
    out: list[tuple[tuple[int, ...], int]] = []
    complements = _Complements(left, spare)
    for longest in range(size, 0, -1):
        while left[longest]:
            shape, gap = [], size
            fill: tuple[int, ...] | None = (longest,)
            while fill:
                for x in fill:
                    left[x] -= 1
                    gap -= x
                shape += fill
                fill = None
                if gap:
                    best = complements.find(gap) or (complements.largest(gap),)
                    fill = best if best[0] else None
            for x in shape:
                left[x] += 1
            times = min(left[x] // shape.count(x) for x in set(shape))
            for x in shape:
                left[x] -= times
            out.append((tuple(shape), times))
    return out


class Places:
    """Sequence and offset of the r-th piece of a length."""

    def __init__(self, shapes: list[tuple[tuple[int, ...], int]]):
        slots: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for shape, times in shapes:
            offset = 0
            for length in shape:
                slots.setdefault(length, []).append((times, first, offset))
                offset += length
            first += times
        self.sequences = first
        self.slots = {}
        for length, entries in slots.items():
            times, firsts, offsets = (np.array(x, np.int64) for x in zip(*entries))
            self.slots[length] = (np.cumsum(times), times, firsts, offsets)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(length[order])) + 1, [len(order)]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            some = order[a:b]
            if len(some):
                upto, times, firsts, offsets = self.slots[int(length[some[0]])]
                at = np.searchsorted(upto, rank[some], side="right")
                sequence[some] = firsts[at] + rank[some] - (upto[at] - times[at])
                offset[some] = offsets[at]
        return sequence, offset


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    size: int = SIZE,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    A document is its ids and ``end_id``; a null or empty text is the end id alone. A document above ``size`` ids is
    cut so that all pieces but the first have ``size`` ids. Repeated rows are packed each. Other columns are ignored.
    Pieces of equal length are interchangeable; which of them goes where follows the order of the input files.
    """
    tokenizer = read_json(tokenizer_path)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = spaced_encoder(tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64).tolist()
        for batch in batches:
            for a, b, _, _ in slices(batch.column(1), BATCH_BYTES):
                some = batch.slice(a, b - a)
                out = []
                for key, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    at, piece = 0, 0
                    while at < n:
                        length = (n - at) % size or size
                        own = ids[4 * at : 4 * (at + length)]
                        kept = own if with_ids else None
                        out.append((key, piece, at, length, zlib.crc32(own), part, seen[length], kept))
                        seen[length] += 1
                        at, piece = at + length, piece + 1
                yield _batch(out, _PIECES)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = materialize(rows.mapInArrow(cut, _PIECES), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = materialize(counts, "piece_counts")
    of_length = counts.groupBy("length").agg(F.sum("n").alias("n"))
    # At most ``size`` rows.
    places = Places(plan({r["length"]: r["n"] for r in of_length.collect()}, size))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(6).to_numpy() + batch.column(8).to_numpy()
            sequence, offset = places.find(length, rank)
            columns = [batch.column(i) for i in (0, 1, 2, 3, 4, 7)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=[c.split()[0] for c in _PLACED.split(", ")],
            )

    # The offsets grow with the number of tasks: no broadcast.
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).select(*pieces.columns, "before")
    placed = ranked.mapInArrow(place, _PLACED)
    return placed if with_ids else placed.drop("ids")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names)
    )
