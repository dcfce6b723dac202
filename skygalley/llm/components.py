"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of a link with the smallest node reachable; links may repeat.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest of them. The links end
    as one star per component after a number of rounds that grows as the logarithm of the component's size squared.
    Every round is written to the shared folder, so no round depends on the executors of the last one.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
    edges = materialize(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    return tuple(sums.first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.where("u > v")
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
