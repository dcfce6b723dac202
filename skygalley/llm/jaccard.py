"""N-gram Jaccard join: documents whose sets of word n-grams are similar, and the classes such links form.

Method: rare-first prefix filtering. Document frequencies of all n-grams are counted over all texts (packed by
hash, ``_offer``, ``_count``). A set, ordered by frequency, must share one of its first n - ceil(t n) + 1 n-grams
with every similar set (``_order``). Sets meet on these prefix n-grams under length and positional filters and
a suffix filter that compares how both sets spread over ranges of the hash space; a pair belongs only to the first
prefix n-gram it shares (``_partners``) and is verified there once (``_links``). Equal sets are one class before that.

A group doesn't emit its pairs: it sends back members that have a partner, then spanning links. A set is
compared with those sets only that it is not yet connected with. Groups above ``BLOCK`` members are split into
blocks, every two of which meet in a task of their own. Only pairs of long texts that share none of their first
``EARLIER`` prefix n-grams, but a later one, are made explicit, once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygalley.llm import exchange as X
from skygalley.llm.components import components
from skygalley.llm.words import slices, words_of

WIDTH = 3
SIMILARITY = Fraction(9, 10)
# Members of one prefix n-gram that meet in one task.
BLOCK = 2048
# Earlier prefix n-grams that a member brings along. A pair that may share an earlier one beyond these is sent on as a pair.
EARLIER = 64
# Ranges of the hash space whose counts bound the overlap of two sets.
RANGES = 16

_SETS = "row long, doc_id long, n_shingles long, digest binary, prefix binary, shared binary"
_PARTNERS = "shingle long, left int, right int, row long, other long"
_LINKS = "a long, b long"


def similar_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    similarity: Fraction = SIMILARITY,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    Words are runs outside space and 0x09-0x0D, after lower-casing A-Z. The set of a text holds its distinct
    ``width``-word sequences; with fewer words, the whole text as one; without words, or null, nothing. Two rows
    link when |intersection| >= similarity * |union|, in exact arithmetic, also rows with equal sets. Empty sets link
    with nothing. Rows that share a doc_id are judged one by one; a row without doc_id links, but gives no
    component_id unless alone (null). Other columns are ignored.
    """
    chunks, buckets = X.chunked(docs, doc_id, text)
    similarity = Fraction(similarity)
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0, 1 at most")

    def offer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _offer(key[0].as_py(), table, width, buckets)

    def order(key: tuple[pa.Scalar, ...], table: pa.Table, counts: pa.Table) -> pa.Table:
        return _order(key[0].as_py(), table, counts, width, similarity, buckets)

    by_chunk = chunks.groupBy("chunk")
    counts = by_chunk.applyInArrow(offer, X.PACKED).groupBy("bucket").applyInArrow(_count, X.PACKED)
    ordered = by_chunk.cogroup(counts.groupBy("chunk")).applyInArrow(order, _SETS)
    sets = X.materialize(ordered, "sets")

    some = sets.where("digest is not null")
    first = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    distinct = some.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    distinct = X.materialize(distinct, "distinct_sets")
    links = X.materialize(_verified(distinct, similarity), "links")
    classes = components(links, "a", "b")  # node, component: both rows of distinct sets

    named = distinct.select(F.col("row").alias("node"), "doc_id", "digest")
    joined = named.join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    smallest = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_digest = joined.join(smallest, "component").select("digest", "component_id")
    alone = sets.where("digest is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    rest = some.join(by_digest, "digest").select("doc_id", "n_shingles", "component_id")
    return alone.unionByName(rest)


def _verified(distinct: DataFrame, similarity: Fraction) -> DataFrame:
    """Links (a, b) between rows of distinct sets that connect all that similar pairs connect."""
    prefixes = distinct.select("row", "n_shingles", "prefix").mapInArrow(
        _prefix_rows, "shingle long, row long, n long, nth int, place int, prefix binary"
    )
    # A long text has many prefix rows, so no size known beforehand bounds either side: no broadcast.
    sizes = prefixes.groupBy("shingle").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    met = (
        prefixes.hint("merge")
        .join(sizes.hint("merge"), "shingle")
        .withColumn("mine", F.pmod(F.xxhash64("row"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "shingle",
            F.least("mine", "other").alias("left"),
            F.greatest("mine", "other").alias("right"),
            "mine",
            "row",
            "n",
            "nth",
            "place",
            "prefix",
        )
    )
    task = ["shingle", "left", "right"]

    def find(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _partners(key, table, similarity)

    def verify(table: pa.Table) -> pa.Table:
        return _links(table, similarity)

    def verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pair_links(batches, similarity)

    partners = X.materialize(met.groupBy(*task).applyInArrow(find, _PARTNERS), "partners")
    sets = distinct.select("row", "n_shingles", "shared").hint("merge")
    members = partners.where("other is null").drop("other").hint("merge").join(sets, "row")
    within = members.groupBy(*task).applyInArrow(verify, _LINKS)
    others = sets.select(
        F.col("row").alias("other"), F.col("n_shingles").alias("other_n"), F.col("shared").alias("other_shared")
    )
    pairs = partners.where("other is not null").select("row", "other").distinct()
    both = pairs.hint("merge").join(sets, "row").join(others.hint("merge"), "other")
    apart = both.select("row", "other", "n_shingles", "other_n", "shared", "other_shared").mapInArrow(
        verify_pairs, _LINKS
    )
    return within.unionByName(apart)


def _sets_of(table: pa.Table, width: int):
    """Slice by slice: (first row, texts, text of each distinct n-gram, its hash), ordered by text and hash."""
    for row, _, data, offsets in slices(X.one_array(table["text"])):
        w = words_of(data, offsets, lower=True)
        texts = len(offsets) - 1
        grams, owner = [w.sequences(width)[w.fits(width)]], [w.text[w.fits(width)]]
        count = np.diff(w.first)
        for n in range(1, width):
            at = w.first[:-1][count == n]
            grams.append(w.sequences(n)[at] ^ np.uint64(n))
            owner.append(w.text[at])
        gram, text = np.concatenate(grams), np.concatenate(owner)
        order = np.lexsort((gram, text))
        gram, text = gram[order], text[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
        yield row, texts, text[new], gram[new]


def _offer(chunk: int, table: pa.Table, width: int, buckets: int) -> pa.Table:
    """Slots of all n-grams of a chunk, each with the number of its texts that hold it."""
    parts = [X.slots(gram, buckets) for _, _, _, gram in _sets_of(table, width)]
    slot, count = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)
    low, count = slot.astype(np.uint32), count.astype(np.uint32)
    bucket = (slot >> np.uint64(32)).astype(np.int64)
    return X.packed_table(
        [(chunk, b, X.pack(X.deltas(low[i:j]), count[i:j])) for b, i, j in X.bucket_ranges(bucket)]
    )


def _count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each chunk: those of its slots that two texts or more hold, with their number."""
    chunks = table["chunk"].to_pylist()
    parts = [X.unpack(p) for p in table["payload"].to_pylist()]
    slot, source, order, begins = X.shared_sorted([X.sums(p[0]) for p in parts])
    count = np.concatenate([p[1] for p in parts]).astype(np.int64)
    total = np.empty(len(slot), dtype=np.int64)
    total[order] = np.repeat(
        np.add.reduceat(count[order], begins), np.diff(begins, append=len(slot))
    )
    bounds = np.searchsorted(source, np.arange(len(chunks) + 1))
    out = []
    for chunk, a, b in zip(chunks, bounds[:-1], bounds[1:]):
        told = total[a:b] > 1
        if told.any():
            payload = X.pack(X.deltas(slot[a:b][told]), total[a:b][told].astype(np.uint64))
            out.append((chunk, key[0].as_py(), payload))
    return X.packed_table(out)


def _prefix_length(n: np.ndarray, similarity: Fraction) -> np.ndarray:
    return n - -(-n * similarity.numerator // similarity.denominator) + 1


def _order(
    chunk: int, table: pa.Table, counts: pa.Table, width: int, similarity: Fraction, buckets: int
) -> pa.Table:
    """Per text its size and, if a prefix n-gram occurs elsewhere, the shared prefix and all shared n-grams.

    An n-gram that no other text holds takes its place in the order, but can't be met and is not sent on.
    """
    known, rest = X.known_slots(counts)
    frequency = np.concatenate([r[0] for r in rest]).astype(np.int64) if rest else np.zeros(0, np.int64)
    ids = table["doc_id"].to_pylist()
    out = []
    for row, texts, text, gram in _sets_of(table, width):
        slot = X.slots(gram, buckets)
        df = np.ones(len(gram), dtype=np.int64)
        found = X.member(slot, known)
        df[found] = frequency[np.searchsorted(known, slot[found])]
        size = np.bincount(text, minlength=texts)
        order = np.lexsort((gram, df, text))
        place = np.arange(len(gram)) - (np.cumsum(size) - size)[text]
        met = (place < _prefix_length(size, similarity)[text]) & (df[order] > 1)
        met_gram, met_place, met_text = gram[order][met], place[met], text[met]
        prefix_at = np.searchsorted(met_text, np.arange(texts + 1))
        shared, shared_text = gram[df > 1], text[df > 1]
        shared_at = np.searchsorted(shared_text, np.arange(texts + 1))
        gram_at = np.searchsorted(text, np.arange(texts + 1))
        for i in range(texts):
            a, b = prefix_at[i], prefix_at[i + 1]
            key = (chunk << 32) + row + i
            if a == b:
                out.append((key, ids[row + i], int(size[i]), None, None, None))
                continue
            whole = gram[gram_at[i] : gram_at[i + 1]]
            prefix = np.stack([met_gram[a:b], met_place[a:b].astype(np.uint64)])
            out.append(
                (
                    key,
                    ids[row + i],
                    int(size[i]),
                    _digest(whole),
                    _ranges(shared[shared_at[i] : shared_at[i + 1]]).tobytes() + prefix.tobytes(),
                    shared[shared_at[i] : shared_at[i + 1]].tobytes(),
                )
            )
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*out)) if out else [()] * 6
    names = ["row", "doc_id", "n_shingles", "digest", "prefix", "shared"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _digest(grams: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _ranges(grams: np.ndarray) -> np.ndarray:
    """How many n-grams lie in each range of the hash space."""
    shift = np.uint64(64 - (RANGES - 1).bit_length())
    return np.bincount((grams >> shift).astype(np.int64), minlength=RANGES).astype(np.uint32)


_SPREAD = 4 * RANGES


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ns, prefixes = (batch.column(i).to_pylist() for i in range(3))
        for row, n, prefix in zip(rows, ns, prefixes):
            grams, places = np.frombuffer(prefix[_SPREAD:], np.uint64).reshape(2, -1)
            spread, earlier = prefix[:_SPREAD], grams[:EARLIER].tobytes()
            for at in range(0, len(grams), 4096):
                nth = np.arange(at, min(at + 4096, len(grams)))
                size = len(nth)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[nth].astype(np.int64)),
                        pa.array(np.full(size, row, np.int64)),
                        pa.array(np.full(size, n, np.int64)),
                        pa.array(nth.astype(np.int32)),
                        pa.array(places[nth].astype(np.int32)),
                        pa.array([spread + earlier[: 8 * i] for i in nth.tolist()], pa.binary()),
                    ],
                    names=["shingle", "row", "n", "nth", "place", "prefix"],
                )


def _partners(key: tuple[pa.Scalar, ...], table: pa.Table, similarity: Fraction) -> pa.Table:
    """Members of a task that have a possible partner whose first shared prefix n-gram is the task's; pairs not sure of it."""
    gram, left, right = (k.as_py() for k in key)
    table = table.sort_by("row")
    m = len(table)
    rows = table["row"].to_numpy()
    n = table["n"].to_numpy()
    place = table["place"].to_numpy().astype(np.int64)
    sure = table["nth"].to_numpy() <= EARLIER
    mine = table["mine"].to_numpy()
    prefixes = table["prefix"].to_pylist()
    ranges = np.stack([np.frombuffer(p[:_SPREAD], np.uint32) for p in prefixes]).astype(np.int64)
    earlier = [np.frombuffer(p[_SPREAD:], np.uint64) for p in prefixes]
    owner = np.repeat(np.arange(m), [len(e) for e in earlier])
    own_at = np.searchsorted(owner, np.arange(m + 1))
    _, name = np.unique(np.concatenate(earlier), return_inverse=True)
    mark = np.zeros(int(name.max(initial=-1)) + 1, dtype=np.int64)
    num, den = similarity.numerator, similarity.denominator
    has = np.zeros(m, dtype=bool)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(m - 1):
        j = np.arange(i + 1, m)
        if left != right:
            j = j[mine[j] != mine[i]]
        need = -(-num * (n[i] + n[j]) // (num + den))  # overlap that similar sets have at least
        j = j[
            (np.minimum(n[i], n[j]) * den >= num * np.maximum(n[i], n[j]))
            & (1 + np.minimum(n[i] - place[i] - 1, n[j] - place[j] - 1) >= need)
            & (np.minimum(ranges[i], ranges[j]).sum(axis=1) >= need)
        ]
        if not len(j):
            continue
        own = name[own_at[i] : own_at[i + 1]]
        mark[own] = 1
        met = np.zeros(len(name) + 1, dtype=np.int64)
        np.cumsum(mark[name], out=met[1:])
        mark[own] = 0
        j = j[met[own_at[j + 1]] == met[own_at[j]]]  # no earlier n-gram in common
        here = sure[j] & sure[i]
        if here.any():
            has[i] = True
            has[j[here]] = True
        if not here.all():
            pairs.append((np.full(int((~here).sum()), rows[i]), rows[j[~here]]))
    first = np.concatenate([rows[has], *[p[0] for p in pairs]])
    other = pa.concat_arrays(
        [pa.nulls(int(has.sum()), pa.int64()), *[pa.array(p[1], pa.int64()) for p in pairs]]
    )
    size = len(first)
    return pa.table(
        [
            pa.array(np.full(size, gram, np.int64)),
            pa.array(np.full(size, left, np.int32)),
            pa.array(np.full(size, right, np.int32)),
            pa.array(first, pa.int64()),
            other,
        ],
        names=["shingle", "left", "right", "row", "other"],
    )


def _pair_links(batches: Iterator[pa.RecordBatch], similarity: Fraction) -> Iterator[pa.RecordBatch]:
    num, den = similarity.numerator, similarity.denominator
    for batch in batches:
        out = []
        for row, other, n, m, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            sets = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(*sets, assume_unique=True))
            if common * den >= num * (n + m - common):
                out.append((row, other))
        a, b = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(table: pa.Table, similarity: Fraction) -> pa.Table:
    """Verifies the members of a task against each other; as many links as connect them."""
    table = table.sort_by("row")
    m = len(table)
    rows, n = table["row"].to_numpy(), table["n_shingles"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table["shared"].to_pylist()]
    length = np.array([len(s) for s in sets])
    at = np.concatenate(([0], np.cumsum(length)))
    _, name = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(name.max(initial=-1)) + 1, dtype=np.int64)
    num, den = similarity.numerator, similarity.denominator
    group = np.arange(m)
    out = []
    for i in range(m - 1):
        j = np.arange(i + 1, m)
        j = j[(group[j] != group[i]) & (np.minimum(n[i], n[j]) * den >= num * np.maximum(n[i], n[j]))]
        if not len(j):
            continue
        mark[name[at[i] : at[i + 1]]] = 1
        some = np.repeat(at[j] - (np.cumsum(length[j]) - length[j]), length[j]) + np.arange(
            int(length[j].sum())
        )
        common = np.add.reduceat(mark[name[some]], np.cumsum(length[j]) - length[j])
        mark[name[at[i] : at[i + 1]]] = 0
        for k in j[common * den >= num * (n[i] + n[j] - common)]:
            if group[k] != group[i]:
                out.append((int(rows[i]), int(rows[k])))
                group[group == group[k]] = group[i]
    a, b = zip(*out) if out else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
