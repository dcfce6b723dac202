"""Exact dedup through an index of cuckoo filters.

Method: the digests of live documents are split into buckets by hash. A bucket's cuckoo filter holds a fingerprint for each
live digest, and supports insertion and deletion. A hit is only a candidate: it is verified against the digests stored
with the bucket. A filter that overflows is rebuilt at twice its size from those stored keys. A first index inside
each task merges copies before the shuffle, so a text that a third of all rows share is one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize
from skygalley.llm.words import LOWER, slices

# Rows behind one bucket of the index, and live digests of a task's own index before it is passed on.
BUCKET_ROWS = 1 << 16
TASK_DIGESTS = 1 << 16
SLOTS = 4
KICKS = 500

_LIVE = "digest binary, doc_id long, row long, copies long"


class CuckooIndex:
    """Live digests with what is kept for each: a cuckoo filter in front, the digests themselves behind."""

    def __init__(self, capacity: int = 64):
        self.stored: dict[bytes, tuple] = {}
        self.resizes = 0
        self._clear(capacity)

    def _clear(self, capacity: int) -> None:
        self.buckets = 1 << max(1, (-(-capacity // SLOTS) - 1).bit_length())
        self.table: list[list[int]] = [[] for _ in range(self.buckets)]
        self._next = 0

    @staticmethod
    def _fingerprint(digest: bytes) -> int:
        return int.from_bytes(digest[:2], "little") or 1

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        f = self._fingerprint(digest)
        a = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return f, a, self._other(a, f)

    def _other(self, place: int, fingerprint: int) -> int:
        return (place ^ (fingerprint * 0x5BD1E995)) & (self.buckets - 1)

    def maybe(self, digest: bytes) -> bool:
        f, a, b = self._places(digest)
        return f in self.table[a] or f in self.table[b]

    def get(self, digest: bytes) -> tuple | None:
        """What is stored for a live digest; a hit of the filter alone is not enough."""
        return self.stored.get(digest) if self.maybe(digest) else None

    def insert(self, digest: bytes, value: tuple) -> None:
        """A digest that is not live, or a new value for one that is."""
        if self.get(digest) is None and not self._add(digest):
            self.stored[digest] = value
            self._resize()
        self.stored[digest] = value

    def delete(self, digest: bytes) -> bool:
        """Whether the digest was live. Only verified digests leave, so no other one's fingerprint is taken away."""
        if self.get(digest) is None:
            return False
        f, a, b = self._places(digest)
        self.table[a if f in self.table[a] else b].remove(f)
        del self.stored[digest]
        return True

    def _add(self, digest: bytes) -> bool:
        f, a, b = self._places(digest)
        for place in (a, b):
            if len(self.table[place]) < SLOTS:
                self.table[place].append(f)
                return True
        place = a
        for _ in range(KICKS):
            self._next = (self._next + 1) % SLOTS
            own = self.table[place]
            own[self._next], f = f, own[self._next]
            place = self._other(place, f)
            if len(self.table[place]) < SLOTS:
                self.table[place].append(f)
                return True
        return False  # one fingerprint has no place: the caller rebuilds from the stored keys

    def _resize(self) -> None:
        capacity = self.buckets * SLOTS
        while True:
            capacity *= 2
            self.resizes += 1
            self._clear(capacity)
            if all(self._add(d) for d in self.stored):
                return


def merge_copies(index: CuckooIndex, digest: bytes, doc_id: int | None, row: int, copies: int) -> None:
    """Of equal digests the row with the largest doc_id stays (none is smallest), of equal ids the later row."""
    old = index.get(digest)
    if old is None:
        index.insert(digest, (doc_id, row, copies))
        return
    rank = (old[0] is not None, old[0] or 0, old[1])
    if (doc_id is not None, doc_id or 0, row) > rank:
        index.delete(digest)
        index.insert(digest, (doc_id, row, old[2] + copies))
    else:
        index.insert(digest, (old[0], old[1], old[2] + copies))


def _live_batch(index: CuckooIndex) -> pa.RecordBatch:
    values = list(zip(*index.stored.values())) if index.stored else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(index.stored), pa.binary()), *[pa.array(v, pa.int64()) for v in values]],
        names=["digest", "doc_id", "row", "copies"],
    )


def digests(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] = ()
) -> DataFrame:
    """Per row: doc_id, digest (SHA-256 of the UTF-8 text after lower-casing A-Z; null counts as empty), c0, c1, ..."""
    names = ["doc_id", "digest", *[f"c{i}" for i in range(len(carry))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, data, offsets in slices(batch.column(1)):
                lowered = memoryview(data.tobytes().translate(LOWER))
                bounds = offsets.tolist()
                out += [hashlib.sha256(lowered[a:b]).digest() for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column(0), pa.array(out, pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    kinds = [f", c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry)]
    return rows.mapInArrow(run, "doc_id long, digest binary" + "".join(kinds))


def exact_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] = ()
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, digest, and ``carry``.

    Texts are equal if they are the same after lower-casing A-Z; null counts as empty. Of equal texts the row with the
    largest doc_id stays; of rows that also share that id, one. Without any id in a group keep_id is null and one row
    stays. ``carry`` names columns of unique row numbers or the like to hand through; other columns are ignored.
    """
    rows = digests(docs, doc_id, text, carry)
    # Written once: from here on the texts are not needed, and row numbers stay what they are.
    rows = materialize(rows, "digests").withColumn("row", F.monotonically_increasing_id())
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for digest, key, row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                merge_copies(index, digest, key, row, 1)
                if len(index.stored) >= TASK_DIGESTS:
                    yield _live_batch(index)
                    index = CuckooIndex()
        yield _live_batch(index)

    def in_bucket(table: pa.Table) -> pa.Table:
        index = CuckooIndex()
        for values in zip(*(table[c].to_pylist() for c in ("digest", "doc_id", "row", "copies"))):
            merge_copies(index, *values)
        return pa.Table.from_batches([_live_batch(index)])

    live = rows.select("digest", "doc_id", "row").mapInArrow(in_task, _LIVE)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")
    kept = live.groupBy(bucket.alias("bucket")).applyInArrow(in_bucket, _LIVE)
    kept = kept.select(
        F.col("digest").alias("of"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "copies"
    )
    joined = rows.join(kept, F.col("digest") == F.col("of"))
    return joined.select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "digest",
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
    )

