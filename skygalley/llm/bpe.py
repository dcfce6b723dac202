"""Byte-level BPE encoding and decoding of whole texts.

Method: the tokenizers library over Arrow batches. A rank file becomes a vocabulary over the printable characters
that stand for bytes; decoding reverses that table, token by token, into bytes, so characters that are
split between tokens come out whole. Offsets count characters; a token that holds a part of a character has it all.
The work is a map over documents: no shuffle, no group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.llm.tokens import SPACE_KEPT, encoder, read_ranks, tokenizer_of_ranks
from skygalley.llm.words import slices

_ENCODED = "doc_id long, n_tokens long, ids binary"
# Text handled at a time in a worker.
BATCH_BYTES = 1 << 20


def _pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, _, _ in slices(batch.column(column), BATCH_BYTES):
            yield batch.slice(a, b - a)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    offsets: bool = False,
    decoded: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), and on request more.

    ``offsets``: starts and ends, arrays of the first character of each token and the one after its last.
    ``decoded``: the ids turned back into bytes. Each match of ``pattern`` is encoded by itself; no special tokens: text
    that spells one is text. Null and empty texts have no tokens. Other columns are ignored.
    """
    tokens = read_ranks(ranks_path)
    tokenizer = tokenizer_of_ranks(tokens, pattern)
    schema = _ENCODED
    if offsets:
        schema += ", starts array<int>, ends array<int>"
    if decoded:
        schema += ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, SPACE_KEPT)
        for batch in _pieces(batches, 1):
            texts = batch.column(1).to_pylist()
            ids = enc.encode(texts)
            columns = [
                batch.column(0),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array(ids, pa.binary()),
            ]
            names = ["doc_id", "n_tokens", "ids"]
            if offsets:
                spans = [token_spans(t or "", i, tokens) for t, i in zip(texts, ids)]
                columns += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                names += ["starts", "ends"]
            if decoded:
                columns.append(pa.array([token_bytes(i, tokens) for i in ids], pa.binary()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _narrow(docs, doc_id, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: doc_id, decoded (bytes of the text). Null ids give no bytes; an unknown id raises."""
    tokens = read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 1):
            out = [token_bytes(i or b"", tokens) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"]
            )

    rows = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded binary")


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def token_bytes(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def token_spans(text: str, ids: bytes, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets of tokens, from their lengths in bytes and the byte at which each character begins."""
    size = np.array([len(tokens[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)
    end = np.cumsum(size)
    data = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return (
        character[end - size].astype(np.int32),
        (character[end - 1] + 1).astype(np.int32),
    )
