"""Connected components of an undirected graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, v, m): both directions of each edge, with the least of u and all its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    return _lowest(edges).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that has a smaller one in its component, with the least of them.

    `edges` has comparable columns u and v without nulls; loops and repeated edges do no harm, and no edge gives no row.
    Rounds grow with the logarithm of the longest path; each is written, so lost executors repeat one round at most. A
    node with many neighbours is one row of partial minima for each task, and a join that adaptive execution splits.
    """
    state, before = stored(edges.where("u <> v").distinct(), "edges"), None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            return state.select("u", "v")
        before = now
        contracted = _small_star(_large_star(state).where("u <> v").distinct()).where("u <> v").distinct()
        state = stored(contracted, "edges")
