"""Connected components of a graph given as edges, by alternating stars.

Each round points the neighbours of every node to the smallest node it knows,
first the larger ones, then the smaller ones, until every component is a star
around its smallest node; the rounds grow with the logarithm of the longest
path. A round is grouping with partial sums and equi-joins, so a node with very
many neighbours is one row per task where it is grouped, and a skewed join, that
Spark splits, where it is joined. Every round is written to the shared folder.

Self-loops and repeated edges are harmless; an edge with a null end is ignored;
no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.llm.common import store

MAX_ROUNDS = 100  # far more than any path of a real graph needs


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v, low): each pair with the smallest node that u is paired with."""
    # Stored, the grouped side is shuffled by the join itself, which Spark can then split
    # where one node has very many pairs.
    lows = store(pairs.groupBy("u").agg(F.min("v").alias("low")), "lows")
    return pairs.join(lows, "u")


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star; edges (u, v) have u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = store(_star(both).filter("v > u").select(
        F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct(), "edges")
    small = _star(large)
    return small.select("u", F.col("low").alias("v")).unionByName(
        small.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))).distinct()


def _mark(edges: DataFrame):
    return edges.agg(
        F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge with the smallest node it is linked to."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u <> v").distinct()
    pairs = store(pairs, "edges")
    mark = _mark(pairs)
    for _ in range(MAX_ROUNDS):
        pairs = store(_round(pairs), "edges")
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
