"""Hourly token flow over a transfer stream, and the transfers that came too late for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import HOUR_MS
from tidemark.functions.values import hour_of_millis
from tidemark.operators.flows import FLOW_KEY, average_size, flow_amount, flow_measures
from tidemark.streaming.sinks import BatchWriter, read_batches, upsert_sink

# 30 seconds of disorder plus 5 minutes of allowed lateness.
ALLOWED_MS = 330_000


#: What the flow of a token is made of.
FLOW_INPUT = ["chain", "token_address", "timestamp", "from_address", "to_address", "amount"]


def _closes() -> Column:
    """The end of a transfer's hour."""
    return F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(HOUR_MS)) + F.lit(HOUR_MS)


def log_path(path: str) -> str:
    """Where the transfers lie that the hourly rows under `path` are made of."""
    return f"{path}_transfers"


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """The transfers that came in time for their hour, each once."""
    return read_batches(spark, log_path(path))


def read_sides(spark: SparkSession, path: str) -> DataFrame:
    """Rows of (chain, token, hour, side, address): n, volume, largest, updated_at, as `flows.token_flow_of` adds them up."""
    side = lambda out, name: F.struct(F.lit(out).alias("out"), F.col(name).alias("address"))
    sides = F.inline(F.array(side(True, "from_address"), side(False, "to_address")))
    rows = read_transfers(spark, path).select("chain", "token_address", hour_of_millis(F.col("timestamp")).alias("hour"), flow_amount().alias("volume"), F.timestamp_millis("timestamp").alias("updated_at"), sides)
    return rows.select(*FLOW_KEY, "out", "address", F.lit(1).cast("long").alias("n"), "volume", F.col("volume").alias("largest"), "updated_at")


def hourly_sink(path: str, progress: str, allowed_ms: int = ALLOWED_MS) -> BatchWriter:
    """A batch writer that logs the transfers that are in time and makes the hours they touch from the log so far.

    The log is the state: a row for each transfer, and nothing is shuffled to keep it, so distinct addresses are counted
    exactly and no row holds a set of them. A transfer is late once the highest event time of the earlier batches has
    passed the end of its hour by the allowed lateness; late ones never raise that time. A batch reads the log of its own
    span only, by a range that reaches the files' statistics.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen_before(spark, progress, batch_id)
        punctual = batch.where(_closes() + F.lit(allowed_ms) > F.lit(seen)).select(*FLOW_INPUT)
        upsert_sink(log_path(path))(punctual, batch_id)
        log = spark.read.schema(punctual.schema.add("batch_id", "long")).parquet(log_path(path)).where(F.col("batch_id") <= batch_id)
        span = log.where(F.col("batch_id") == batch_id).agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).first()
        newest = seen if span.last is None else max(seen, span.last)
        spark.range(1).select(F.lit(newest).cast("long").alias("max_ms")).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")
        first, last = (0, -1) if span.last is None else (span.first // HOUR_MS * HOUR_MS, span.last // HOUR_MS * HOUR_MS + HOUR_MS - 1)
        known = log.where(F.col("timestamp").between(F.lit(first), F.lit(last)))
        hours = known.groupBy("chain", "token_address", hour_of_millis(F.col("timestamp")).alias("hour")).agg(
            *flow_measures(), F.max(F.timestamp_millis("timestamp")).alias("updated_at"), F.max("batch_id").alias("_touched")
        )
        counts = ["transfer_count", "unique_senders_count", "unique_receivers_count", "total_volume"]
        touched = hours.where(F.col("_touched") == batch_id).select(*FLOW_KEY, *counts, average_size().alias("avg_transfer_size"), "max_transfer_size", "updated_at")
        upsert_sink(path)(touched, batch_id)

    return write


def late_transfers(path: str, progress: str, allowed_ms: int = ALLOWED_MS) -> BatchWriter:
    """A batch writer that keeps the transfers whose hour had already closed.

    An hour is closed once the highest event time of the earlier batches has
    passed its end by the allowed lateness, which is when the windowed query
    drops its rows. The highest time up to each batch is stored under `progress`
    by batch id, so a replayed batch sees the same past and reads one row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen_before(spark, progress, batch_id)
        closes = _closes()
        late = batch.where((closes + F.lit(allowed_ms)) <= F.lit(seen)).select(
            "*",
            hour_of_millis(F.col("timestamp")).alias("hour"),
            closes.alias("window_end_ms"),
            (F.lit(seen) - closes).alias("late_by_ms"),
        )
        late.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        batch.agg(F.greatest(F.max("timestamp"), F.lit(seen)).alias("max_ms")).write.mode("overwrite").parquet(
            f"{progress}/batch_id={batch_id}"
        )

    return write


def _seen_before(spark: SparkSession, progress: str, batch_id: int) -> int:
    """One number: the highest event time of all earlier batches, from the row of the last one."""
    if batch_id == 0:
        return -(2**62)
    return spark.read.parquet(f"{progress}/batch_id={batch_id - 1}").first()["max_ms"]
