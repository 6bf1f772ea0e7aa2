"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: The edges of one node are dealt over so many tasks, and more where adaptive execution splits a skewed join.
SALTS = 8
#: Up to so many edges, two minima of 16 bytes each (8 MB), the minima are sent to every task instead (a count of the written edges decides).
BROADCAST_EDGES = 250_000


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to its centre and no centre has one."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"))))
    nodes = edges.select(ends.alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("up"), F.min("x.up").alias("least"))
    return nodes.filter("up > 1 or (up = 1 and least = 0)").isEmpty()


def _with_low(edges: DataFrame, low: DataFrame, few: bool) -> DataFrame:
    """``edges`` with the minimum of their a; both sides of the join are dealt out by node and salt, or few minima broadcast."""
    if few:
        return edges.join(F.broadcast(low), "a")
    salted = low.select("a", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    return own.join(salted, ["a", "salt"]).drop("salt")


def connected_components(edges: DataFrame, cut: Callable[[DataFrame, str], DataFrame], most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest id that a node of ``edges`` (a, b) is connected to.

    ``cut`` writes a DataFrame and reads it back, so each step's plan is short and its
    rows are computed once. Nodes only in self edges are left out. Minima are aggregated
    before they are shuffled, and the edges of one node are joined with its minimum in
    several tasks, however many edges it has; the minima of few edges are broadcast.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut(e, "edges")
    for k in range(most_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        few = e.count() <= BROADCAST_EDGES
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = _with_low(both.filter("b > a"), low, few).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large if few else large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            _with_low(large, low, few)
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("x"))
            .select("x.*")
            .filter("a <> b")
            .distinct()
        )
        e = cut(small, f"edges{k}")
        if _is_settled(e):
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
