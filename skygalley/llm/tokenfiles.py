"""Token ids in files, in ascending id of the documents, with constant-time access by key.

The format is a Parquet dataset. A row is a block: the raw ids of consecutive documents (little-endian unsigned 32-bit),
their keys, and an index. Method of the index: a minimal perfect hash over the block's keys (levels of bit arrays; a
key that shares its bit goes on to the next level, the rank of its bit is its slot) with a fingerprint and the place of
the document in each slot. ``first_id`` and ``last_id`` of the blocks lead a key to its block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygalley.llm.exchange import pack, text_bytes, unpack
from skygalley.llm.tokens import read_json, word_encoder
from skygalley.llm.words import mix, slices

# Text of a shard (one file), ids of a block, text encoded at a time.
SHARD_BYTES = 16 << 20
BLOCK_IDS = 1 << 19
BATCH_BYTES = 1 << 20

_BLOCKS = (
    "shard int, block int, n_docs long, n_tokens long, first_id long, last_id long, "
    "keys binary, index binary, ids binary"
)
_ROWS = "shard int, block int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


class KeyIndex:
    """Minimal perfect hash over distinct 64-bit keys; each slot holds a fingerprint, a row and a number of rows."""

    def __init__(self, levels: list[np.ndarray], fingerprints, first_row, n_rows):
        self.levels, self.fingerprints = levels, fingerprints
        self.first_row, self.n_rows = first_row, n_rows
        counts = [int(bits.sum()) for bits in levels]
        self._before = [np.cumsum(bits) - bits for bits in levels]
        self._base = np.cumsum([0, *counts])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(keys ^ mix(np.full(1, level + 1, np.uint64))) % np.uint64(size)

    @classmethod
    def build(cls, keys: np.ndarray, n_rows: np.ndarray) -> KeyIndex:
        levels, left = [], keys
        while len(left):
            size = 2 * len(left)
            place = cls._place(left, len(levels), size)
            bits = np.bincount(place.astype(np.int64), minlength=size) == 1
            levels.append(bits)
            left = left[~bits[place.astype(np.int64)]]
        none = np.zeros(len(keys), np.uint32)
        out = cls(levels, none, none.copy(), none.copy())
        slot = out.slots(keys)
        out.fingerprints[slot] = cls.fingerprint(keys)
        out.first_row[slot] = np.cumsum(n_rows) - n_rows
        out.n_rows[slot] = n_rows
        return out

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return mix(keys + np.uint64(0x5851F42D4C957F2D)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """-1 where no level has the key's bit, as for most keys that are not in the index."""
        out = np.full(len(keys), -1, dtype=np.int64)
        for level, bits in enumerate(self.levels):
            todo = np.flatnonzero(out < 0)
            place = self._place(keys[todo], level, len(bits)).astype(np.int64)
            hit = bits[place]
            out[todo[hit]] = self._base[level] + self._before[level][place[hit]]
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; no rows where the fingerprint is another one."""
        slot = self.slots(keys)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == self.fingerprint(keys[known])
        first, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], n[known] = self.first_row[slot[known]], self.n_rows[slot[known]]
        return first, n

    def to_bytes(self) -> bytes:
        sizes = np.array([len(bits) for bits in self.levels], np.uint64)
        bits = np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)]))
        return pack(sizes, bits, self.fingerprints, self.first_row, self.n_rows)

    @classmethod
    def from_bytes(cls, payload: bytes) -> KeyIndex:
        sizes, bits, fingerprints, first_row, n_rows = unpack(payload)
        bits = np.unpackbits(bits, count=int(sizes.sum())).astype(bool)
        levels = np.split(bits, np.cumsum(sizes)[:-1].astype(np.int64)) if len(sizes) else []
        return cls(levels, fingerprints, first_row, n_rows)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode all texts and write their ids, each document followed by ``end_id``, as a dataset at ``path``.

    Null and empty texts have the end id only. Rows without doc_id come first. Rows of one doc_id stand side by side and
    are one key with several rows. Other columns are ignored. The sort moves texts, which are smaller than their ids.
    """
    tokenizer = read_json(tokenizer_path)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(tokenizer)
        shard, block = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        ids: list[bytes] = []
        held = 0
        for batch in batches:
            for a, b, _, _ in slices(batch.column(1), BATCH_BYTES):
                part = batch.slice(a, b - a)
                for key, found in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    if held and held + len(found) > 4 * BLOCK_IDS:
                        yield _block(shard, block, keys, ids)
                        block, keys, ids, held = block + 1, [], [], 0
                    keys.append(key)
                    ids.append(found + end)
                    held += len(found) + 4
        if keys:
            yield _block(shard, block, keys, ids)

    shards = max(1, -(-text_bytes(docs, text) // SHARD_BYTES))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    in_order = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    in_order.mapInArrow(run, _BLOCKS).write.option("compression", "zstd").parquet(path)


def _block(shard: int, block: int, keys: list[int | None], ids: list[bytes]) -> pa.RecordBatch:
    nulls = sum(k is None for k in keys)
    named = np.array(keys[nulls:], np.int64)
    distinct, n_rows = np.unique(named, return_counts=True)
    index = KeyIndex.build(distinct.astype(np.uint64), n_rows)
    index.first_row[:] += np.uint32(nulls)
    size = np.array([len(i) // 4 for i in ids], np.uint64)
    row = [
        shard,
        block,
        len(keys),
        int(size.sum()),
        int(named[0]) if len(named) else None,
        int(named[-1]) if len(named) else None,
        pack(np.array([nulls], np.uint64), distinct.astype(np.uint64), size),
        index.to_bytes(),
        b"".join(ids),
    ]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 3]
    names = ["shard", "block", "n_docs", "n_tokens", "first_id", "last_id", "keys", "index", "ids"]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(path)


def _rows_of(block: dict, keys: np.ndarray | None) -> tuple[list, np.ndarray, list[bytes]]:
    """Keys, starts and ids of a block's documents, found through its index; all keys if none are given."""
    nulls, distinct, size = unpack(block["keys"])
    first, n = KeyIndex.from_bytes(block["index"]).find(distinct if keys is None else keys)
    rows = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    found = np.repeat(distinct if keys is None else keys, n).astype(np.int64).tolist()
    if keys is None:
        rows = np.concatenate((np.arange(int(nulls[0])), rows))
        found = [None] * int(nulls[0]) + found
    end = np.cumsum(size).astype(np.int64)
    start = end - size.astype(np.int64)
    ids = block["ids"]
    return found, start[rows], [ids[4 * start[r] : 4 * end[r]] for r in rows]


def _row_batch(block: dict, keys: np.ndarray | None, with_ids: bool = True) -> pa.RecordBatch:
    found, start, ids = _rows_of(block, keys)
    n = len(found)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block["shard"]] * n, pa.int32()),
            pa.array([block["block"]] * n, pa.int32()),
            pa.array(found, pa.int64()),
            pa.array(start, pa.int64()),
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([zlib.crc32(i) for i in ids], pa.int64()),
            pa.array(ids if with_ids else [None] * n, pa.binary()),
        ],
        names=["shard", "block", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
    )


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """All documents of a dataset: shard, block, doc_id, start (ids before it in the whole dataset), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), ids.

    Every key is looked up in its block's index. The starts come from a join of all rows; without ids (null, on request)
    those are some 40 bytes a document, and the ids never leave the task that reads them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _row_batch(batch.slice(i, 1).to_pylist()[0], None, with_ids)

    rows = _blocks(spark, path).select("shard", "block", "keys", "index", "ids")
    return _from_start(rows.mapInArrow(run, _ROWS), _blocks(spark, path))


def read_keys(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of some keys, as ``read_ids`` gives them; unknown and null keys give no row.

    A key is compared with the ranges of all blocks (some two million ids each); only the blocks found are opened.
    Within a block a key costs one look into its index.
    """
    ranges = _blocks(spark, path).select("shard", "block", "first_id", "last_id")
    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").distinct()
    met = wanted.join(ranges, F.col("key").between(F.col("first_id"), F.col("last_id")))
    per_block = met.groupBy("shard", "block").agg(F.collect_list("key").alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                yield _row_batch(block, np.array(sorted(block["wanted"]), np.int64).astype(np.uint64))

    rows = _blocks(spark, path).select("shard", "block", "keys", "index", "ids")
    return _from_start(
        rows.join(per_block, ["shard", "block"]).mapInArrow(run, _ROWS), _blocks(spark, path)
    )


def _from_start(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Starts counted from the dataset's first id: sums over shards (one row each), then over a shard's blocks."""
    sizes = blocks.select("shard", "block", "n_tokens")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_shard")
    )
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.join(shards, "shard").select(
        "shard",
        "block",
        (F.col("before_shard") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("before"),
    )
    return rows.join(offsets, ["shard", "block"]).withColumn(
        "start", F.col("start") + F.col("before")
    ).drop("before")


