"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stage_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node hands its smallest neighbour (or itself) to
    its larger (large star) or smaller (small star) neighbours."""
    pairs = _both_ways(edges)
    if not large:
        pairs = pairs.where(F.col("b") < F.col("a"))
    # min() combines in each task, so a centre with most of the edges is one
    # row per task here; adaptive execution splits it in the join.
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = pairs.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), two longs.

    The component is its smallest node. Edges are directed from the larger to
    the smaller node; rounds of a large star and a small star shrink the graph
    until each node points at its component. The edges of every round are
    written to the shared folder, so lost executors cost one round at most.
    Null ends and loops are dropped; repeated edges count once.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )
    now = stage_table(edges.distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        now = stage_table(_star(_star(now, large=True), large=False), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _mark(edges: DataFrame) -> tuple:
    """Order-free fingerprint of an edge set."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 40)))
    ).collect()[0]
    return tuple(row)
