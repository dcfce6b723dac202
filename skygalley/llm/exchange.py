"""Exchanges of many small values between tasks as a few packed rows.

``chunked`` deals documents into chunks of bounded text; ``packed_rows`` splits what a chunk has to tell
into one binary value per bucket of the hash space. Spark shuffles those rows by bucket and back by chunk.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.session import new_table_root

# Text of one chunk and text behind one bucket of hashes. More memory per task allows larger ones.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
PACKED = "chunk int, bucket int, payload binary"
_PACKED_SCHEMA = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the folder all executors share, and read it back: this cuts the lineage."""
    spark = df.sparkSession
    path = f"{new_table_root(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame) -> tuple[DataFrame, str]:
    """A number for every row of a table in files, under a name that no column has."""
    name = "row_id"
    while name in df.columns:
        name = f"_{name}"
    return df.withColumn(name, F.monotonically_increasing_id()), name


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def chunked(docs: DataFrame, doc_id: str, text: str, carry: list[str] = ()) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text, c0, c1, ...) dealt by the id's hash, and the number of hash buckets to use.

    Rows without an id are dealt by their row number.
    """
    total = text_bytes(docs, text)
    chunks, buckets = (max(1, -(-total // size)) for size in (CHUNK_BYTES, BUCKET_BYTES))
    key = F.coalesce(F.col(doc_id).cast("long"), -F.monotonically_increasing_id() - 1)
    out = docs.select(
        F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int").alias("chunk"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    return out, buckets


def in_id_order(table: pa.Table) -> pa.Table:
    """Rows of a chunk by id (none first) and, for rows of one id, by text."""
    order = pa.compute.sort_indices(
        table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"
    )
    return table.take(order)


def ids_of(table: pa.Table) -> np.ndarray:
    """Ids as numbers; no id is the smallest number."""
    column = table["doc_id"].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.int64())
    return column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def one_array(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    return column


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, bytes of equal weight side by side, compressed."""
    head = [struct.pack("<B", len(arrays))]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<BQ", a.itemsize, len(a)))
        body.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpack(payload: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, at, out = raw[0], 1, []
    shapes = []
    for _ in range(n):
        shapes.append(struct.unpack_from("<BQ", raw, at))
        at += 9
    for itemsize, length in shapes:
        planes = np.frombuffer(raw, np.uint8, itemsize * length, at).reshape(itemsize, length)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{itemsize}").reshape(length))
        at += itemsize * length
    return out


def deltas(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def sums(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d, dtype=d.dtype)


def slots(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket above, 32 bits of the hash below: what stands for a hash in an exchange that may err."""
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    return (bucket << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def bucket_ranges(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of an ascending array."""
    if len(bucket):
        edges = np.flatnonzero(np.diff(bucket)) + 1
        bounds = np.concatenate(([0], edges, [len(bucket)]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield int(bucket[a]), int(a), int(b)


def packed_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.table([pa.array(c, t.type) for c, t in zip(columns, _PACKED_SCHEMA)], schema=_PACKED_SCHEMA)


def shared_sorted(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Several key arrays as one: (all keys, source of each, sorting order, where a new key begins)."""
    whole = np.concatenate(keys)
    source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    order = np.argsort(whole, kind="stable")
    ordered = whole[order]
    begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return whole, source, order, begins


def member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is among the ascending known ones."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def known_slots(table: pa.Table) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Slots told to a chunk, ascending, and the packed arrays that follow the slots, bucket by bucket."""
    rows = sorted(zip(table["bucket"].to_pylist(), table["payload"].to_pylist()))
    parts = [(np.uint64(b) << np.uint64(32), unpack(p)) for b, p in rows]
    if not parts:
        return np.zeros(0, dtype=np.uint64), []
    known = np.concatenate([b | sums(p[0]).astype(np.uint64) for b, p in parts])
    return known, [p[1:] for _, p in parts]


