"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two aggregations with map-side partials and two joins; its
result is written to the shared folder. Rounds grow with the logarithm of the
longest chain. Only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustolake.llm._shared import staged

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a").where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, root): the smallest node of each node's component.

    Self-loops, repeated edges and nulls are ignored; nodes without an edge do not appear.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        now = staged(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
