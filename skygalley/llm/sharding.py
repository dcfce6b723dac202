"""Dealing documents into shards by a keyed permutation of their row numbers.

Method: a Feistel network permutes 0 .. 2^b - 1; walking its cycles until a value below the number of rows comes gives a
permutation of the rows. Row r goes to shard p(r) mod n, slot p(r) div n: shards differ by one row at most, slots have no gap,
and anyone who knows the key, the count and r computes shard and slot without a table; ``row_at`` goes back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize
from skygalley.llm.words import mix

SHARDS = 40
ROUNDS = 6
# Groups by id hash in which rows are numbered; also the rows of the table of their offsets.
GROUPS = 4096


class Permutation:
    """A permutation of 0 .. rows - 1 given by a seed."""

    def __init__(self, rows: int, seed: int):
        self.rows = rows
        self.half = max(1, (max(rows - 1, 1).bit_length() + 1) // 2)
        self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([seed], np.uint64)))

    def _walk(self, x: np.ndarray, keys: np.ndarray, swap: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        if swap:
            left, right = right, left
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & mask)
        if swap:
            left, right = right, left
        return (left << half) | right

    def _cycle(self, x: np.ndarray, keys: np.ndarray, swap: bool) -> np.ndarray:
        out = self._walk(x.astype(np.uint64), keys, swap)
        while len(beyond := np.flatnonzero(out >= self.rows)):
            out[beyond] = self._walk(out[beyond], keys, swap)
        return out.astype(np.int64)

    def place_of(self, row: np.ndarray) -> np.ndarray:
        return self._cycle(row, self.keys, False)

    def row_at(self, place: np.ndarray) -> np.ndarray:
        return self._cycle(place, self.keys[::-1], True)


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes of the text and 16), text_crc32, row_number, shard, slot.

    Rows are numbered by a hash group of the id, then by id, size and checksum, so the numbers do not depend on files or
    tasks; only rows alike in all three may change places. A null text counts as empty. Other columns are ignored.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)).cast("int"))
    rows = materialize(rows, "rows_to_number")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    # GROUPS rows at most, whatever the table's size.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    permutation = Permutation(rows.count(), seed)

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for row in batches:
            yield pd.Series(permutation.place_of(row.to_numpy()))

    own = Window.partitionBy("part").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("nth", F.row_number().over(own) - 1).join(offsets, "part")
    numbered = numbered.withColumn("row_number", (F.col("before") + F.col("nth")).cast("long"))
    return numbered.withColumn("place", place("row_number")).select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )
