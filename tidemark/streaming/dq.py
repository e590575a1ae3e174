"""Message quality per topic over a stream, with anomaly flags."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.dq_windows import (
    FRESH_STATS,
    LATE_MS,
    SLIDE_MS,
    WINDOW_MS,
    finish_window,
    flag_rows,
    is_blank,
    with_latency,
)
from tidemark.sources.streams import DISORDER

STATS = "mean_rate double, std_rate double, mean_latency double, std_latency double, samples long"


def dq_stream(
    messages: DataFrame,
    window_ms: int = WINDOW_MS,
    slide_ms: int = SLIDE_MS,
    late_ms: int = LATE_MS,
    delay: str = DISORDER["messages"],
) -> DataFrame:
    """Sliding-window metrics. The percentiles are exact nearest-rank values; their state counts each latency that occurs
    in whole milliseconds, so it grows with the different latencies of a window and not with its messages."""
    latency = F.col("latency_ms")
    rows = with_latency(messages).withColumn("event_time", F.timestamp_millis("timestamp"))
    percentile = F.expr("percentile_disc(array(0.95D, 0.99D)) within group (order by latency_ms)")
    summed = (
        rows.withWatermark("event_time", delay)
        .groupBy(
            F.window("event_time", f"{window_ms} milliseconds", f"{slide_ms} milliseconds").alias("w"), "topic"
        )
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.count_if(is_blank(F.col("value"))).alias("null_count"),
            F.count_if(latency > late_ms).alias("late_arrival_count"),
            F.sum(latency).alias("latency_sum"),
            percentile.alias("_p"),
            F.max(latency).cast("double").alias("max_latency_ms"),
            F.min("timestamp").alias("first_ms"),
            F.max("timestamp").alias("last_ms"),
        )
        .select(
            "*",
            F.unix_millis("w.start").alias("window_from"),
            F.col("_p")[0].cast("double").alias("p95_latency_ms"),
            F.col("_p")[1].cast("double").alias("p99_latency_ms"),
        )
    )
    return finish_window(summed, window_ms)


def flag_topic(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(chunks)).sort_values("window_from")
    flagged, stats = flag_rows(rows, state.get if state.exists else FRESH_STATS)
    state.update(stats)
    yield flagged


def flag_stream(windows: DataFrame) -> DataFrame:
    """Anomaly flags over a stream of closed windows (each window arrives once)."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.schema.fields)
    return windows.groupBy("topic").applyInPandasWithState(
        flag_topic,
        f"{columns}, is_rate_anomaly int, is_latency_anomaly int",
        STATS,
        "append",
        GroupStateTimeout.NoTimeout,
    )
