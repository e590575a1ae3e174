"""Latest row per key and additive merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key under `order`.

    Written as `row_number() = 1`: the planner then keeps one row per key
    inside every input task before the shuffle, so a key with a third of all
    rows sends one row per task, not its whole history.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_version(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Upsert view of an append log: the highest version of each key.

    Rows with an equal version are ordered by their remaining columns, so the
    result does not depend on the order the files are read in.
    """
    rest = [F.col(f.name).desc() for f in df.schema.fields
            if f.name not in (*keys, version) and f.dataType.typeName() not in ("map", "variant")]
    return latest_by(df, keys, [F.col(version).desc(), *rest])


def sum_merge(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Additive merge: one row per key with every measure summed."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
