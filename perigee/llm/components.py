"""Connected components of a graph, as DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.session import work_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b), the component being its smallest node.

    A distributed union-find by alternating stars: a node hands its larger neighbours to the
    smallest it knows, then its smaller ones, until every component is a star around its
    smallest node. Minima are taken per task before they are shuffled, and a hub's edges are split by the join
    if they are many. Each round is written to the shared folder, so a lost executor costs a re-read.
    """
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = work_table(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = work_table(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return (
        edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), "b"), F.struct(F.col("b").alias("node"), "b"))))
        .select("col.node", F.col("col.b").alias("component"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    handed = edges.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return handed.union(least.select("a", F.col("least").alias("b"))).distinct()
