"""Message quality per topic and sliding window, and anomalies over it (batch form)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import from_millis

LATE_MS = 60_000
WINDOW_MS = 60_000
SLIDE_MS = 30_000

# The detector's parameters.
ALPHA = 0.1
Z_LIMIT = 3.0
WARM_UP = 10
FIRST_STD_RATE = 1.0
FIRST_STD_LATENCY = 10.0
FLOOR_STD_RATE = 0.1
FLOOR_STD_LATENCY = 1.0


def with_latency(messages: DataFrame) -> DataFrame:
    """Latency is processing time minus message time, in whole milliseconds."""
    return messages.withColumn("latency_ms", F.col("processing_time") - F.col("timestamp"))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def dq_window_metrics(
    messages: DataFrame,
    window_ms: int = WINDOW_MS,
    slide_ms: int = SLIDE_MS,
    late_ms: int = LATE_MS,
    chain: str = "base",
) -> DataFrame:
    """Count, rate, blanks, late arrivals and latency figures per topic and window.

    Messages are first counted per (topic, slide, latency), so the shuffle
    carries a latency histogram instead of messages and a busy topic is
    combined before it moves. Slides are then copied into the windows that
    cover them. Nearest-rank percentiles are exact: they are read off the
    running count over the histogram, which is a sorted, spillable window.
    """
    if window_ms % slide_ms:
        raise ValueError("the window must be a whole number of slides")
    slide = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(slide_ms))
    histogram = (
        with_latency(messages)
        .groupBy("topic", slide.alias("slide"), "latency_ms")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(is_blank(F.col("value"))).alias("blank"),
            F.min("timestamp").alias("first_ms"),
            F.max("timestamp").alias("last_ms"),
        )
    )
    starts = F.sequence(F.col("slide") - F.lit(window_ms - slide_ms), F.col("slide"), F.lit(slide_ms))
    covered = histogram.withColumn("window_from", F.explode(starts)).drop("slide")
    of_window = Window.partitionBy("topic", "window_from")
    ranked = covered.withColumn("upto", F.sum("n").over(of_window.orderBy("latency_ms"))).withColumn(
        "total", F.sum("n").over(of_window)
    )

    def percentile(p: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.col("latency_ms")))

    late = F.when(F.col("latency_ms") > late_ms, F.col("n")).otherwise(0)
    summed = ranked.groupBy("topic", "window_from").agg(
        F.sum("n").alias("message_count"),
        F.sum("blank").alias("null_count"),
        F.sum(late).alias("late_arrival_count"),
        F.sum(F.col("n") * F.col("latency_ms")).alias("latency_sum"),
        percentile(0.95).cast("double").alias("p95_latency_ms"),
        percentile(0.99).cast("double").alias("p99_latency_ms"),
        F.max("latency_ms").cast("double").alias("max_latency_ms"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
    )
    return finish_window(summed, window_ms, chain)


def finish_window(summed: DataFrame, window_ms: int, chain: str = "base") -> DataFrame:
    """Rates and averages of summed windows.

    `window_start` and `window_end` are the first and last message times, and
    the rate is taken over that span (at least one second); the bounds of the
    window itself are `window_from` and `window_to`.
    """
    span = F.greatest(F.lit(1.0), (F.col("last_ms") - F.col("first_ms")) / F.lit(1000.0))
    return summed.select(
        F.lit(chain).alias("chain"),
        "topic",
        from_millis(F.col("window_from")).alias("window_from"),
        from_millis(F.col("window_from") + F.lit(window_ms)).alias("window_to"),
        "message_count",
        (F.col("message_count") / span).alias("message_rate_per_sec"),
        "null_count",
        F.lit(0).cast("bigint").alias("schema_error_count"),
        F.lit(0).cast("bigint").alias("duplicate_count"),
        "late_arrival_count",
        (F.col("latency_sum") / F.col("message_count")).alias("avg_latency_ms"),
        "p95_latency_ms",
        "p99_latency_ms",
        "max_latency_ms",
        from_millis(F.col("first_ms")).alias("window_start"),
        from_millis(F.col("last_ms")).alias("window_end"),
    )


def message_faults(messages: DataFrame, window_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS) -> DataFrame:
    """Opt-in counts the plain metrics leave at 0: values that are not JSON and
    repeated (partition, offset) pairs, per topic and window."""
    broken = ~is_blank(F.col("value")) & F.try_parse_json("value").isNull()
    slide = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(slide_ms))
    starts = F.sequence(F.col("slide") - F.lit(window_ms - slide_ms), F.col("slide"), F.lit(slide_ms))
    per_offset = messages.groupBy("topic", slide.alias("slide"), "partition", "offset").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("broken")
    )
    per_window = per_offset.withColumn("window_from", F.explode(starts)).groupBy(
        "topic", "window_from", "partition", "offset"
    ).agg(F.sum("n").alias("n"), F.sum("broken").alias("broken"))
    return per_window.groupBy("topic", "window_from").agg(
        F.sum("broken").alias("schema_error_count"), F.sum(F.col("n") - 1).alias("duplicate_count")
    ).withColumn("window_from", from_millis(F.col("window_from")))


FRESH_STATS = (None, FIRST_STD_RATE, None, FIRST_STD_LATENCY, 0)


def detector_step(stats: tuple, rate: float, latency: float) -> tuple[tuple, bool, bool]:
    """One window through the detector: new statistics and the two flags.

    `stats` is (mean rate, std rate, mean latency, std latency, samples); a
    mean of None starts at the first value. Flags use the statistics from
    before the window and stay off during the warm-up.
    """
    mean_rate, std_rate, mean_latency, std_latency, samples = stats
    mean_rate = rate if mean_rate is None else mean_rate
    mean_latency = latency if mean_latency is None else mean_latency
    warm = samples >= WARM_UP
    off_rate, off_latency = rate - mean_rate, latency - mean_latency
    rate_flag = warm and abs(off_rate) / std_rate > Z_LIMIT
    latency_flag = warm and abs(off_latency) / std_latency > Z_LIMIT
    keep = 1 - ALPHA
    updated = (
        mean_rate * keep + rate * ALPHA,
        max(math.sqrt(std_rate * std_rate * keep + off_rate * off_rate * ALPHA), FLOOR_STD_RATE),
        mean_latency * keep + latency * ALPHA,
        max(math.sqrt(std_latency * std_latency * keep + off_latency * off_latency * ALPHA), FLOOR_STD_LATENCY),
        samples + 1,
    )
    return updated, rate_flag, latency_flag


def flag_rows(rows: pd.DataFrame, stats: tuple) -> tuple[pd.DataFrame, tuple]:
    """Run one topic's ordered windows through the detector."""
    rate_flags, latency_flags = [], []
    for rate, latency in zip(rows["message_rate_per_sec"], rows["avg_latency_ms"]):
        stats, rate_flag, latency_flag = detector_step(stats, float(rate), float(latency))
        rate_flags.append(int(rate_flag))
        latency_flags.append(int(latency_flag))
    return rows.assign(is_rate_anomaly=rate_flags, is_latency_anomaly=latency_flags), stats


def detect_anomalies(windows: DataFrame) -> DataFrame:
    """Flag windows whose rate or average latency leaves the topic's moving band.

    Each window depends on the one before, so a topic's windows stay in order
    in one partition. They stream through in Arrow batches with five numbers
    carried over; their number is set by the covered time, not by the volume
    of messages.
    """
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        topic, stats = None, FRESH_STATS
        for batch in batches:
            parts = []
            for name, rows in batch.groupby("topic", sort=False):
                if name != topic:
                    topic, stats = name, FRESH_STATS
                flagged, stats = flag_rows(rows, stats)
                parts.append(flagged)
            if parts:
                yield pd.concat(parts)

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.schema.fields)
    return (
        windows.repartition("topic")
        .sortWithinPartitions("topic", "window_from")
        .mapInPandas(fold, f"{columns}, is_rate_anomaly int, is_latency_anomaly int")
    )
