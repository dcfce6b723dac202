"""Approximate nearest neighbours by Euclidean distance, through robust-pruned directed graphs.

Method: equal vectors are one node. Nodes are dealt into shards by hash; every shard gets a graph in one task. Greedy
searches from the shard's middle propose neighbours for a node; relaxed distance pruning (a candidate goes if it is
``ALPHA`` times nearer to a neighbour already chosen) keeps few, diverse edges, and reverse edges are pruned the
same way. A query runs a beam search on every shard, and the nearest of all shards are ranked by exact distances.
Searches run in lockstep for a batch of queries, as array operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize, one_array, pack, unpack

# Vectors of a shard, edges of a node, relaxation, and beam widths.
SHARD_VECTORS = 8192
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 96
SEARCH_BEAM = 192
# Queries that meet a shard in one task, and searches that run together.
QUERY_BLOCK = 4096
LOCKSTEP = 256

FARTHEST = np.finfo(np.float64).max

_HITS = "query_id long, point long, vec_id long, score double"
_HIT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.float64())


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared, of each q (b, d) to its own x (b, c, d); what is beyond the largest number counts as that number."""
    diff = x - q[:, None, :]
    return np.minimum(np.einsum("bcd,bcd->bc", diff, diff), FARTHEST)


def _power(values: np.ndarray, axis: int | None = None) -> np.ndarray:
    """The power of two above the largest size among the values, by which they can be divided exactly; 1 for zeros."""
    _, exponent = np.frexp(np.abs(values).max(axis=axis, initial=0.0, keepdims=axis is not None))
    return np.ldexp(1.0, np.clip(exponent, -1000, 1000))


def exact_distances(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision; scaled, so that no square leaves the range of numbers."""
    diff = points - q
    scale = _power(diff, axis=1)
    return np.sqrt(((diff / scale) ** 2).sum(axis=1)) * scale[:, 0]


def beam_search(
    vectors: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes found for each query and their squared distances, nearest first.

    ``graph`` and ``vectors`` have one row more than nodes: the node that stands for none.
    """
    none, b = len(vectors) - 1, len(queries)
    row = np.arange(b)
    seen = np.zeros((b, none + 1), dtype=bool)
    ids = np.full((b, width), none)
    dist = np.full((b, width), np.inf)
    done = np.ones((b, width), dtype=bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = _distances(queries, vectors[np.full((b, 1), entry)])[:, 0]
    seen[:, entry] = True
    while True:
        open_ = np.where(done, np.inf, dist)
        at = open_.argmin(axis=1)
        live = np.flatnonzero(np.isfinite(open_[row, at]))
        if not len(live):
            break
        node = ids[live, at[live]]
        done[live, at[live]] = True
        near = graph[node]
        new = ~seen[live[:, None], near] & (near != none)
        seen[live[:, None], near] = True
        d = np.where(new, _distances(queries[live], vectors[near]), np.inf)
        all_d = np.concatenate((dist[live], d), axis=1)
        best = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        dist[live] = np.take_along_axis(all_d, best, 1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], near), axis=1), best, 1)
        done[live] = np.take_along_axis(np.concatenate((done[live], ~new), axis=1), best, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    dist, ids = np.take_along_axis(dist, order, 1), np.take_along_axis(ids, order, 1)
    return np.where(np.isfinite(dist), ids, none), dist


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` of the candidates ``near`` of each node; a row may hold a candidate twice."""
    none = len(vectors) - 1
    b = len(nodes)
    row = np.arange(b)
    points = vectors[near]
    dist = _distances(vectors[nodes], points)
    dist[(near == none) | (near == nodes[:, None])] = np.inf
    out = np.full((b, degree), none)
    for k in range(degree):
        at = dist.argmin(axis=1)
        some = np.isfinite(dist[row, at])
        if not some.any():
            break
        pick = near[row, at]
        out[some, k] = pick[some]
        between = _distances(vectors[pick], points)
        dist[(between <= dist / ALPHA**2) & some[:, None]] = np.inf
        dist[row, at] = np.inf
    return out


def build_graph(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges of the nodes (all rows but the last, which stands for none) and the node to start from."""
    none = len(vectors) - 1
    random = np.random.Generator(np.random.PCG64(11))
    graph = np.full((none + 1, DEGREE), none)
    if none > 1:
        start = min(DEGREE // 2, none - 1)
        graph[:none, :start] = (np.arange(none)[:, None] + random.integers(1, none, (none, start))) % none
    middle = vectors[:none].mean(axis=0)
    entry = int(((vectors[:none] - middle) ** 2).sum(axis=1).argmin())
    order = random.permutation(none)
    for at in range(0, none, LOCKSTEP):
        nodes = order[at : at + LOCKSTEP]
        found, _ = beam_search(vectors, graph, entry, vectors[nodes], min(BUILD_BEAM, none))
        near = np.concatenate((found, graph[nodes]), axis=1)
        graph[nodes] = robust_prune(vectors, nodes, near, DEGREE)
        _add_reverse(vectors, graph, nodes)
    return graph, entry


def _add_reverse(vectors: np.ndarray, graph: np.ndarray, nodes: np.ndarray) -> None:
    none = len(vectors) - 1
    target = graph[nodes].ravel()
    source = np.repeat(nodes, DEGREE)
    target, source = target[target != none], source[target != none]
    known = (graph[target] == source[:, None]).any(axis=1)
    target, source = target[~known], source[~known]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    own, first, count = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(own), LOCKSTEP):
        some = slice(at, at + LOCKSTEP)
        width = int(count[some].max())
        column = np.arange(width)
        index = np.minimum(first[some][:, None] + column, len(source) - 1)
        more = np.where(column < count[some][:, None], source[index], none)
        near = np.concatenate((graph[own[some]], more), axis=1)
        free = (near != none).sum(axis=1) <= DEGREE
        if free.any():
            packed = np.sort(near[free], axis=1)[:, :DEGREE]  # "none" is the largest number
            graph[own[some][free]] = packed
        if not free.all():
            graph[own[some][~free]] = robust_prune(vectors, own[some][~free], near[~free], DEGREE)


def _valid(vector: str) -> str:
    finite = f"forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return f"{vector} is not null and {finite} and exists({vector}, x -> x <> 0)"


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by a power of two, so that the largest component is below 1, one row for no node, and the power."""
    scale = _power(vectors)
    return np.concatenate((vectors / scale, np.zeros((1, vectors.shape[1])))), scale


def _shard_index(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    dim = key[0].as_py()
    padded, _ = _scaled(_matrix(table["vector"], dim))
    graph, entry = build_graph(padded)
    payload = pack(graph.astype(np.uint32).ravel(), np.array([entry], np.uint64))
    return pa.table(
        [
            pa.array([dim], pa.int32()),
            pa.array([key[1].as_py()], pa.int32()),
            pa.array([payload], pa.binary()),
            pa.array([table["vector"].to_pylist()], pa.list_(pa.list_(pa.float64()))),
            pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
        ],
        names=["dim", "shard", "graph", "vectors", "ids"],
    )


_INDEX = "dim int, shard int, graph binary, vectors array<array<double>>, ids array<array<long>>"


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return one_array(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(
    vectors: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """A written table with a row per shard: its graph, vectors, and of equal vectors the k + 1 smallest ids.

    More ids of equal vectors can't be among the k nearest of any query, ties going to smaller ids. Repeated rows are one
    candidate; an id with several vectors is a candidate with each of them.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(_valid("vector"))
    rows = rows.withColumn("vector", F.expr("transform(vector, x -> if(x = 0, 0D, x))")).distinct()
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    nodes = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = materialize(nodes.withColumn("dim", F.size("vector")), "nodes")
    shards = max(1, -(-nodes.count() // SHARD_VECTORS))
    shard = F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard")
    return materialize(nodes.groupBy("dim", shard).applyInArrow(_shard_index, _INDEX), "index")


def _search_shard(index: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    if not len(index) or not len(queries):
        return _hits([])
    dim = index["dim"][0].as_py()
    graph, entry = unpack(index["graph"][0].as_py())
    graph = graph.astype(np.int64).reshape(-1, DEGREE)
    exact = one_array(index["vectors"]).flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    padded, scale = _scaled(exact)
    ids = index["ids"][0].as_py()
    none = len(padded) - 1
    query_ids, keys = queries["query_id"].to_pylist(), queries["point"].to_pylist()
    points = _matrix(queries["vector"], dim)
    width = min(max(SEARCH_BEAM, 2 * k), none)
    out: list[tuple[int, int, int, float]] = []
    for at in range(0, len(points), LOCKSTEP):
        part = points[at : at + LOCKSTEP]
        with np.errstate(over="ignore"):
            found, _ = beam_search(padded, graph, int(entry[0]), np.clip(part / scale, -FARTHEST, FARTHEST), width)
        for q, key, point, nodes in zip(query_ids[at : at + LOCKSTEP], keys[at : at + LOCKSTEP], part, found):
            nodes = nodes[nodes != none]
            score = exact_distances(exact[nodes], point)
            near = [(s, i) for s, node in zip(score.tolist(), nodes.tolist()) for i in ids[node] if i != q]
            out += [(q, key, i, s) for s, i in sorted(near)[:k]]
    return _hits(out)


def _hits(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(_HIT_TYPES)
    names = [c.split()[0] for c in _HITS.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(columns, _HIT_TYPES)], names=names)


def nearest(
    index: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Per query and rank (from 1, up to k): query_id, rank, vec_id, score (Euclidean distance in double precision).

    Vectors that are null, zero, or hold null or non-finite numbers take no part, neither do ids that are null. A query is
    never its own neighbour, a row with an equal vector is. Ties go to the smaller vec_id. Only vectors of the query's
    length are searched. With fewer than k candidates all are returned. Repeated query rows are one query; an id with
    several vectors is a query with each, and has ranks from 1 for each. Searches run in double precision on vectors
    scaled by a power of two, so very large and very small numbers are told apart.
    """
    shards = index.select("dim", "shard")
    asked = queries.select(
        F.col(vec_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(_valid("vector") + " and query_id is not null").distinct()
    asked = asked.withColumn("point", F.xxhash64("vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("dim", F.size("vector")).withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    )
    # The stated query set meets every shard, a block of queries at a time.
    met = asked.join(shards, "dim").select("query_id", "point", "vector", *[F.col(c).alias(c) for c in ("dim", "shard", "block")])
    at = ["dim", "shard", "block"]
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_shard(left, right, k)

    hits = copies.groupBy(*at).cogroup(met.groupBy(*at)).applyInArrow(search, _HITS)
    order = Window.partitionBy("query_id", "point").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
