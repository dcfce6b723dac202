"""Substring dedup: words that stand in a passage which also starts earlier are removed.

Method: fixed-block anchors. Every text is cut into blocks of half a window; the blocks are the index, and
all rolling half-windows of all texts probe it (``_offer``, ``_match``). A block whose words occur
nowhere else can't lie in a repeated window, so only windows all of whose blocks were hit are extended to
whole repeated windows, compared by 96 bits of hash (``_extend``, ``_first``); runs of removed windows are the
maximal exact repeats (``_cut``). All exchanges carry one value per distinct sequence and chunk, so a passage
that a third of all texts share is one value per chunk.

Text is shuffled once, by chunk; the three steps over texts read that one shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skygalley.llm import exchange as X
from skygalley.llm.words import slices, words_of

WIDTH = 20


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    carry: list[str] = (),
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (kept words joined by one space), and ``carry``.

    A window is ``width`` consecutive words of one text; it starts earlier than another one of the same words
    if its doc_id is smaller, or the same with an earlier start. Each word that a later window covers is removed.
    Null and empty texts have no words and keep an empty text. Texts below ``width`` words are kept. Rows of one
    doc_id with equal starts are neither earlier than the other, so repeated rows stay as they are; a null doc_id
    comes before all others. Other columns of ``docs`` are ignored unless carried; no input name can clash.
    ``width`` is even, 4 or more.
    """
    if width < 4 or width % 2:
        raise ValueError("width must be even, 4 or more")
    half = width // 2
    chunks, buckets = X.chunked(docs, doc_id, text, carry)
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
            *[T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)],
        ]
    )

    def offer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _offer(key[0].as_py(), table, half, buckets)

    def extend(key: tuple[pa.Scalar, ...], table: pa.Table, hits: pa.Table) -> pa.Table:
        return _extend(key[0].as_py(), table, hits, width, buckets)

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, later: pa.Table) -> pa.Table:
        return _cut(table, later, width, len(carry))

    by_chunk = chunks.groupBy("chunk")
    hits = by_chunk.applyInArrow(offer, X.PACKED).groupBy("bucket").applyInArrow(_match, X.PACKED)
    windows = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend, X.PACKED)
    later = windows.groupBy("bucket").applyInArrow(_first, X.PACKED)
    out = by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(cut, schema)
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carry)})


def _offer(chunk: int, table: pa.Table, half: int, buckets: int) -> pa.Table:
    """Slots of all rolling half-windows of a chunk: whether it occurs more than once, whether it is a block."""
    parts = []
    for _, _, data, offsets in slices(X.one_array(table["text"])):
        w = words_of(data, offsets)
        ok = w.fits(half)
        aligned = (np.arange(len(w.hash)) - w.first[w.text]) % half == 0
        slot = X.slots(w.sequences(half)[ok], buckets)
        parts.append((slot << np.uint64(1)) | aligned[ok].astype(np.uint64))
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    values.sort()
    slot = values >> np.uint64(1)
    last = np.flatnonzero(np.concatenate((slot[1:] != slot[:-1], [True]))) if len(slot) else slot.astype(int)
    count = np.diff(last, prepend=-1)
    flags = ((values[last] & np.uint64(1)).astype(np.uint8)) | ((count > 1).astype(np.uint8) << 1)
    slot = slot[last]
    bucket = (slot >> np.uint64(32)).astype(np.int64)
    low = slot.astype(np.uint32)
    return X.packed_table(
        [(chunk, b, X.pack(X.deltas(low[i:j]), flags[i:j])) for b, i, j in X.bucket_ranges(bucket)]
    )


def _match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each chunk: those of its blocks whose words occur at two places or more."""
    chunks = table["chunk"].to_pylist()
    parts = [X.unpack(p) for p in table["payload"].to_pylist()]
    slot, source, order, begins = X.shared_sorted([X.sums(p[0]) for p in parts])
    flags = np.concatenate([p[1] for p in parts])
    places = np.add.reduceat(1 + (flags[order] >> 1).astype(np.int64), begins)
    told = np.zeros(len(slot), dtype=bool)
    told[order] = np.repeat(places > 1, np.diff(begins, append=len(slot)))
    told &= (flags & 1).astype(bool)
    bounds = np.searchsorted(source, np.arange(len(chunks) + 1))  # keys of a source stand together
    out = [(c, slot[a:b][told[a:b]]) for c, a, b in zip(chunks, bounds[:-1], bounds[1:])]
    bucket = key[0].as_py()
    return X.packed_table([(c, bucket, X.pack(X.deltas(s))) for c, s in out if len(s)])


def _window_hashes(table: pa.Table, width: int):
    """Slice by slice: (first row, words, hash, more hash, windows' first words)."""
    for row, _, data, offsets in slices(X.one_array(table["text"])):
        w = words_of(data, offsets)
        high, low = w.sequences(width), w.sequences(width, 1).astype(np.uint32)
        yield row, w, high, low, np.flatnonzero(w.fits(width))


def _extend(chunk: int, table: pa.Table, hits: pa.Table, width: int, buckets: int) -> pa.Table:
    """Of a chunk's windows all of whose blocks were hit, each distinct one with its first place."""
    known, _ = X.known_slots(hits)
    if not len(known):
        return X.packed_table([])
    half = width // 2
    table = X.in_id_order(table)
    ids = X.ids_of(table)
    highs, lows, rows, starts = [], [], [], []
    for row, w, high, low, at in _window_hashes(table, width):
        size = len(w.hash)
        place = np.arange(size) - w.first[w.text] if size else np.zeros(0, np.int64)
        block = np.flatnonzero(w.fits(half) & (place % half == 0)) if size else place
        hit = np.zeros(size + 1, dtype=bool)
        hit[block] = X.member(X.slots(w.sequences(half)[block], buckets), known)
        inside = at + (-place[at]) % half  # the first block in each window
        second = np.where(inside == at, np.minimum(at + half, size), inside)
        at = at[hit[inside] & hit[second]]
        highs.append(high[at])
        lows.append(low[at])
        rows.append(w.text[at] + row)
        starts.append(place[at])
    high, low, row, start = map(np.concatenate, (highs, lows, rows, starts))
    bucket = ((high >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((start, ids[row], low, high, bucket))
    bucket, high, low, row, start = (a[order] for a in (bucket, high, low, row, start))
    new = np.ones(len(high), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    bucket, high, low, row, start = (a[new] for a in (bucket, high, low, row, start))
    out = []
    for b, i, j in X.bucket_ranges(bucket):
        named, which = np.unique(row[i:j], return_inverse=True)
        out.append(
            (
                chunk,
                b,
                X.pack(
                    X.deltas(high[i:j]),
                    low[i:j],
                    ids[named].astype(np.uint64),
                    which.astype(np.uint32),
                    start[i:j].astype(np.uint32),
                ),
            )
        )
    return X.packed_table(out)


def _first(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each chunk: those of its windows that start earlier in another chunk."""
    chunks = table["chunk"].to_pylist()
    parts = [X.unpack(p) for p in table["payload"].to_pylist()]
    high = np.concatenate([X.sums(p[0]) for p in parts])
    low = np.concatenate([p[1] for p in parts])
    doc = np.concatenate([p[2].astype(np.int64)[p[3]] for p in parts])
    start = np.concatenate([p[4] for p in parts])
    order = np.lexsort((start, doc, low, high))
    new = np.ones(len(order), dtype=bool)
    h, l = high[order], low[order]
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    first = order[new][np.cumsum(new) - 1]
    later = np.zeros(len(order), dtype=bool)
    later[order] = (doc[order] != doc[first]) | (start[order] != start[first])
    out, at, bucket = [], 0, key[0].as_py()
    for chunk, p in zip(chunks, parts):
        mine = slice(at, at + len(p[0]))
        at = mine.stop
        told = later[mine]
        if told.any():
            out.append((chunk, bucket, X.pack(X.deltas(high[mine][told]), low[mine][told])))
    return X.packed_table(out)


def _later_here(high: np.ndarray, low: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows, in the order of their places, that start earlier among those given."""
    order = np.argsort(high, kind="stable")
    h = high[order]
    same = h[1:] == h[:-1]
    twice = np.zeros(len(h), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    some = np.sort(order[twice])
    out = np.zeros(len(high), dtype=bool)
    if len(some):
        order = some[np.lexsort((low[some], high[some]))]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        first = order[new][np.cumsum(new) - 1]
        out[order] = (doc[order] != doc[first]) | (start[order] != start[first])
    return out


def _cut(table: pa.Table, later: pa.Table, width: int, carried: int) -> pa.Table:
    table = X.in_id_order(table)
    ids = X.ids_of(table)
    told = [X.unpack(p) for p in later["payload"].to_pylist()]
    if told:
        told_high = np.concatenate([X.sums(p[0]) for p in told])
        told_low = np.concatenate([p[1] for p in told])
        order = np.lexsort((told_low, told_high))
        told_high, told_low = told_high[order], told_low[order]
    words, highs, lows, docs, starts, places = [], [], [], [], [], []
    for row, w, high, low, at in _window_hashes(table, width):
        words.append(w)
        highs.append(high[at])
        lows.append(low[at])
        docs.append(ids[w.text[at] + row])
        starts.append(at - w.first[w.text[at]])
        places.append(at)
    if not words:
        return _cut_table(table, [], [], [], carried)
    high, low = np.concatenate(highs), np.concatenate(lows)
    removed = _later_here(high, low, np.concatenate(docs), np.concatenate(starts))
    if told:
        some = np.flatnonzero(X.member(high, told_high))
        # equal first hashes are as good as unique, but all told windows of one are looked at
        a = np.searchsorted(told_high, high[some], side="left")
        b = np.searchsorted(told_high, high[some], side="right")
        for k in range(int((b - a).max(initial=0))):
            at = np.minimum(a + k, len(told_low) - 1)
            removed[some[(a + k < b) & (told_low[at] == low[some])]] = True
    counts, dropped, texts, at = [], [], [], 0
    for w, place in zip(words, places):
        size = len(w.hash)
        start = place[removed[at : at + len(place)]]
        at += len(place)
        edge = np.zeros(size + 1, dtype=np.int64)
        np.add.at(edge, start, 1)
        np.subtract.at(edge, start + width, 1)
        covered = np.cumsum(edge[:-1]) > 0
        n = len(w.first) - 1
        counts.append(np.diff(w.first))
        dropped.append(np.bincount(w.text[covered], minlength=n))
        texts.append(joined(w, ~covered))
    return _cut_table(table, counts, dropped, texts, carried)


def joined(w, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    texts = len(w.first) - 1
    start, end, text = w.start[keep], w.end[keep], w.text[keep]
    size = end - start
    if len(size):
        size[:-1] += text[1:] == text[:-1]  # the space after a word that isn't the last of its text
    to = np.cumsum(size)
    total = int(to[-1]) if len(to) else 0
    begin = to - size
    source = np.repeat(start - begin, size) + np.arange(total)
    data = w.data[np.minimum(source, max(len(w.data) - 1, 0))]
    if len(size):
        data[(to - 1)[size > end - start]] = 0x20
    offsets = np.zeros(texts + 1, dtype=np.int64)
    offsets[1:] = np.cumsum(np.bincount(text, weights=size, minlength=texts)).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), texts, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).cast(pa.string())


def _cut_table(table: pa.Table, counts, dropped, texts, carried: int) -> pa.Table:
    def numbers(parts):
        return pa.array(np.concatenate(parts).astype(np.int64) if parts else [], pa.int64())

    return pa.table(
        [
            table["doc_id"],
            numbers(counts),
            numbers(dropped),
            pa.chunked_array(texts, pa.string()),
            *[table[f"c{i}"] for i in range(carried)],
        ],
        names=["doc_id", "n_words", "n_removed", "kept_text", *[f"c{i}" for i in range(carried)]],
    )
