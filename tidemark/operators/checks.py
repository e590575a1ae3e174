"""Data-quality checks. Each returns the failing rows (or one verdict row), lazily."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.addresses import is_valid_address
from tidemark.functions.values import moment


def no_duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are left to `not_null`."""
    return (
        no_duplicates(df.where(F.col(column).isNotNull()), [column])
        .select(F.col(column).alias("unique_field"), F.col("cnt").alias("n_records"))
    )


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return no_duplicates(df, columns).drop("cnt")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Unexpected values with their row counts; NULL counts as neither."""
    return (
        df.where(~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    outside: Column = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return df.where(outside)


def positive_value(df: DataFrame, column: str) -> DataFrame:
    """Fails below zero; zero itself passes."""
    return df.where(F.col(column) < 0).select(F.col(column).alias("invalid_value"))


def valid_address(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_valid_address(F.col(column), strict=False)).select(F.col(column).alias("invalid_address"))


def recent_data(df: DataFrame, column: str, as_of: str | datetime, days: int = 1) -> DataFrame:
    """One row with the row count when the newest value is older than `days`."""
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"), F.max(column).cast("timestamp").alias("_newest"))
        .where(F.col("_newest") < moment(as_of) - F.expr(f"interval {days} days"))
        .select("row_count")
    )


def freshness(df: DataFrame, column: str, max_seconds: int, as_of: str | datetime, name: str) -> DataFrame:
    """Seconds since the newest row; an empty table has no delay and fails."""
    delay = F.unix_seconds(moment(as_of)) - F.unix_seconds(F.max(F.col(column).cast("timestamp")))
    return df.agg(delay.alias("delay_seconds")).select(
        F.lit(name).alias("check_name"),
        "delay_seconds",
        F.lit(max_seconds).cast("bigint").alias("threshold_seconds"),
        F.coalesce(F.col("delay_seconds") > max_seconds, F.lit(True)).alias("failed"),
    )


def completeness(df: DataFrame, columns: list[str], name: str, max_rate: float = 0.01) -> DataFrame:
    """Share of NULLs over the given columns in one pass; an empty table is skipped."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    return (
        df.agg(F.count(F.lit(1)).alias("total"), nulls.alias("null_count"))
        .where(F.col("total") > 0)
        .select(
            F.lit(name).alias("check_name"),
            "total",
            (F.col("null_count") / (F.col("total") * len(columns))).alias("null_rate"),
            (F.col("null_count") / (F.col("total") * len(columns)) > max_rate).alias("failed"),
        )
    )


def consistency(df: DataFrame, as_of: str | datetime, column: str = "dbt_updated_at") -> DataFrame:
    """Health factors below 0 or above 1000 among the rows of the last day."""
    health = F.col("health_factor")
    return (
        df.where(F.col(column) >= moment(as_of) - F.expr("interval 1 day"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(health < 0).alias("negative_hf"),
            F.count_if(health > 1000).alias("extreme_hf"),
        )
        .withColumn("failed", (F.col("negative_hf") > 0) | (F.col("extreme_hf") > 0))
    )


def positions_health_check(
    positions: DataFrame, as_of: str | datetime, max_seconds: int = 86_400, max_rate: float = 0.01
) -> DataFrame:
    """Freshness, completeness and consistency of the positions table from one scan."""
    health, updated = F.col("health_factor"), F.col("dbt_updated_at")
    recent = updated >= moment(as_of) - F.expr("interval 1 day")
    one = positions.agg(
        F.count(F.lit(1)).alias("total"),
        (F.unix_seconds(moment(as_of)) - F.unix_seconds(F.max(updated))).alias("delay_seconds"),
        (F.count_if(health.isNull()) + F.count_if(F.col("total_collateral_usd").isNull())).alias("nulls"),
        F.count_if(recent & (health < 0)).alias("negative_hf"),
        F.count_if(recent & (health > 1000)).alias("extreme_hf"),
    )
    null_rate = F.when(F.col("total") > 0, F.col("nulls") / (F.col("total") * 2))
    return one.select(
        "total",
        "delay_seconds",
        F.coalesce(F.col("delay_seconds") > max_seconds, F.lit(True)).alias("stale"),
        null_rate.alias("null_rate"),
        F.coalesce(null_rate > max_rate, F.lit(False)).alias("incomplete"),
        ((F.col("negative_hf") > 0) | (F.col("extreme_hf") > 0)).alias("inconsistent"),
    )
