"""The streaming jobs: source, transformation, sinks, checkpoint and trigger put together."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import pricing
from tidemark.session import checkpoint_root
from tidemark.streaming import dq, flow, landing, risk
from tidemark.streaming.sinks import BatchWriter, alert_sink, append_sink, split_sink, upsert_sink

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class JobOptions:
    """`available_now` drains the source and stops; otherwise batches start every `interval`.

    Checkpoints live under `run` in the cluster's shared checkpoint folder; a
    restart with the same `run` resumes.
    """

    run: str = "default"
    interval: str = "60 seconds"
    available_now: bool = False


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting that a query reads when it starts; the session gets its own value back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def large_state(spark: SparkSession):
    """Keep operator state in RocksDB, on disk, instead of on the heap."""
    return setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _root(spark: SparkSession, options: JobOptions) -> str:
    return f"{checkpoint_root(spark)}/{options.run}"


def _trigger(options: JobOptions) -> dict:
    return {"availableNow": True} if options.available_now else {"processingTime": options.interval}


def _start(df: DataFrame, name: str, writer: BatchWriter, options: JobOptions, mode: str) -> StreamingQuery:
    root = _root(df.sparkSession, options)
    stream = df.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/{name}").foreachBatch(writer)
    return stream.queryName(name).trigger(**_trigger(options)).start()


def start_risk(positions: DataFrame, metrics_path: str, alerts_path: str, options: JobOptions = JobOptions()):
    writer = split_sink(
        metrics=(risk.metrics_of, upsert_sink(metrics_path)),
        alerts=(risk.alerts_of, append_sink(alerts_path)),
        messages=(risk.alerts_of, alert_sink(f"{alerts_path}_json")),
    )
    spark = positions.sparkSession
    # A query with a processing-time timeout asks for one empty batch after the other; expired state can wait for data.
    with setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false"), large_state(spark):
        return _start(risk.risk_stream(positions), "risk", writer, options, "append")


def start_token_flow(transfers: DataFrame, path: str, options: JobOptions = JobOptions()):
    """Hourly rows under `path`, and the transfers they are made of beside them (`flow.read_transfers`).

    Late rows are judged as `start_late_transfers` judges them. The query keeps no operator state: its log of transfers
    is what later batches add to."""
    root = _root(transfers.sparkSession, options)
    writer = flow.hourly_sink(path, f"{root}/token_flow_progress")
    return _start(transfers, "token_flow", writer, options, "append")


def start_late_transfers(transfers: DataFrame, path: str, options: JobOptions = JobOptions()):
    root = _root(transfers.sparkSession, options)
    writer = flow.late_transfers(path, f"{root}/late_transfers_progress")
    return _start(transfers, "late_transfers", writer, options, "append")


def start_prices(prices: DataFrame, path: str, options: JobOptions = JobOptions()):
    """The price stream to a log that `start_priced_positions` reads."""
    return _start(prices, "prices", append_sink(path), options, "append")


def start_priced_positions(positions: DataFrame, prices_path: str, path: str, options: JobOptions = JobOptions(), fresh_ms: int = pricing.FRESH_MS):
    """Positions beside the newest price of their asset: each batch meets the log of prices as it then is.

    A batch reads the prices of its own span of time and of `fresh_ms` before it, by a range that reaches the files'
    statistics, so the work of a batch is bounded by that span however long the log grows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        first, last = batch.agg(F.min("timestamp"), F.max("timestamp")).first()
        log = batch.sparkSession.read.parquet(prices_path)
        log = log.where(F.col("timestamp").between(F.lit(first) - fresh_ms, F.lit(last)))
        pricing.beside_prices(batch, log, fresh_ms).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(positions, "priced_positions", write, options, "append")


def start_topics(topics: list[DataFrame], delay: str, path: str, options: JobOptions = JobOptions(), policy: str = "min"):
    """Messages of several topics counted by topic and hour, each hour once it has closed for all of them.

    Every topic has its own watermark. By the policy `min` the slowest topic decides which hours are closed, and a topic
    that falls idle holds all others back; by `max` the fastest one decides, and what a slower topic brings for a closed
    hour is late and dropped.
    """
    timed = [t.withColumn("event_time", F.timestamp_millis("timestamp")).withWatermark("event_time", delay) for t in topics]
    rows = reduce(DataFrame.unionByName, timed)
    counts = rows.groupBy(F.window("event_time", "1 hour").alias("w"), "topic").agg(F.count(F.lit(1)).alias("message_count"))
    closed = counts.select("topic", F.col("w.start").alias("hour"), "message_count")
    with setting(rows.sparkSession, "spark.sql.streaming.multipleWatermarkPolicy", policy):
        return _start(closed, "topics", append_sink(path), options, "append")


def start_dq_windows(messages: DataFrame, path: str, options: JobOptions = JobOptions(interval="30 seconds"), **window):
    """Closed windows to a file sink, whose log makes each window appear exactly once to its readers."""
    windows = dq.dq_stream(messages, **window)
    stream = windows.writeStream.outputMode("append").format("parquet").option("path", path)
    stream = stream.option("checkpointLocation", f"{_root(messages.sparkSession, options)}/dq_windows")
    return stream.queryName("dq_windows").trigger(**_trigger(options)).start()


def start_dq_flags(windows: DataFrame, path: str, options: JobOptions = JobOptions(interval="30 seconds")):
    """Flags over the stream of closed windows; the detector's state cannot follow an
    aggregation inside one query, so the windows' table stands between the two."""
    return _start(dq.flag_stream(windows), "dq_flags", append_sink(path), options, "append")


def start_landing(
    messages: DataFrame, ddl: str, out: str, dead_letters: str, within: str | None = None, options: JobOptions = JobOptions()
):
    source = landing.dedup(messages, within) if within else messages
    return _start(source, "landing", landing.land(ddl, out, dead_letters), options, "append")
