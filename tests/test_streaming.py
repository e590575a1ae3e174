"""Each stream, fed in several files, against its batch form."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from oracle.views import raw, spark_view
from tidemark.operators import dq_windows, flows, risk
from tidemark.sources import schemas
from tidemark.sources.streams import StreamConfig, envelope, stream_source
from tidemark.streaming import jobs, landing
from tidemark.streaming.jobs import JobOptions
from tidemark.streaming.sinks import compact_upserts, read_batches, read_upserts


def in_files(df, path, order, parts):
    """Write `df` as `parts` files whose modification order follows `order`."""
    rows = df.withColumn("_part", F.ntile(parts).over(Window.orderBy(order)))
    for part in range(1, parts + 1):
        rows.where(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(path)
    return path


def options(tmp_path):
    return JobOptions(run=uuid.uuid4().hex, available_now=True)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted(map(str, left.select(*columns).collect()))
    b = sorted(map(str, right.select(*columns).collect()))
    assert a == b
    return len(a)


def test_risk_stream_equals_batch(spark, small, tmp_path):
    positions = raw(spark, small, "raw_positions")
    path = in_files(positions, str(tmp_path / "in"), "timestamp", 3)
    stream = stream_source(spark, StreamConfig(path=path, max_files_per_trigger=1), schemas.POSITIONS)
    metrics, alerts = str(tmp_path / "metrics"), str(tmp_path / "alerts")
    jobs.start_risk(stream, metrics, alerts, options(tmp_path)).awaitTermination()
    assert same(read_batches(spark, metrics), risk.risk_metrics(positions)) == positions.count()
    assert same(read_batches(spark, alerts), risk.risk_alerts(positions)) > 0
    messages = read_batches(spark, f"{alerts}_json", "json")
    assert messages.count() == risk.risk_alerts(positions).count()

    keys = ["chain", "protocol", "user_address"]
    current = read_upserts(spark, metrics, keys, "version")
    assert current.count() == positions.select(*keys).distinct().count()
    compact_upserts(spark, metrics, str(tmp_path / "compact"), keys, "version")
    assert same(read_upserts(spark, str(tmp_path / "compact"), keys, "version"), current) > 0


def test_risk_stream_keeps_late_positions(spark, small, tmp_path):
    """Files in falling order of time: every position comes out, however far behind it arrives."""
    positions = raw(spark, small, "raw_positions")
    late = positions.withColumn("timestamp", -F.col("timestamp"))
    path = in_files(late, str(tmp_path / "in"), "timestamp", 3)
    stream = stream_source(spark, StreamConfig(path=path, max_files_per_trigger=1), schemas.POSITIONS)
    stream = stream.withColumn("timestamp", -F.col("timestamp"))
    metrics = str(tmp_path / "metrics")
    jobs.start_risk(stream, metrics, str(tmp_path / "alerts"), options(tmp_path)).awaitTermination()
    key = ["chain", "protocol", "user_address", "block_number", "risk_level"]
    assert same(read_batches(spark, metrics).select(*key), risk.risk_metrics(positions).select(*key)) == positions.count()


def test_token_flow_stream_equals_batch(spark, small, tmp_path):
    transfers = raw(spark, small, "raw_transfers")
    path = in_files(transfers, str(tmp_path / "in"), "timestamp", 3)
    stream = stream_source(spark, StreamConfig(path=path, max_files_per_trigger=1), schemas.TRANSFERS)
    out = str(tmp_path / "flow")
    jobs.start_token_flow(stream, out, options(tmp_path)).awaitTermination()
    got = read_upserts(spark, out, ["chain", "token_address", "hour"], "updated_at")
    want = flows.token_flow_hourly(transfers, "2024-01-30")
    assert same(got.drop("senders", "receivers", "updated_at"), want.drop("updated_at")) > 0


def test_late_transfers_go_to_the_side(spark, small, tmp_path):
    transfers = raw(spark, small, "raw_transfers").orderBy("timestamp").limit(500)
    hours = transfers.agg(F.min("timestamp"), F.max("timestamp")).first()
    path = str(tmp_path / "in")
    transfers.where(F.col("timestamp") > hours[0] + 7_200_000).coalesce(1).write.parquet(path)
    transfers.where(F.col("timestamp") <= hours[0] + 7_200_000).coalesce(1).write.mode("append").parquet(path)
    stream = stream_source(spark, StreamConfig(path=path, max_files_per_trigger=1), schemas.TRANSFERS)
    late, out = str(tmp_path / "late"), str(tmp_path / "flow")
    jobs.start_late_transfers(stream, late, options(tmp_path)).awaitTermination()
    jobs.start_token_flow(stream, out, options(tmp_path)).awaitTermination()
    kept = read_upserts(spark, out, ["chain", "token_address", "hour"], "updated_at").agg(F.sum("transfer_count")).first()[0]
    dropped = read_batches(spark, late)
    assert dropped.count() > 0
    assert kept + dropped.count() == 500
    assert dropped.agg(F.min("late_by_ms")).first()[0] >= 330_000


def test_dq_stream_equals_batch(spark, small, tmp_path):
    messages = spark_view(spark, small, "messages")
    full = messages.withColumn("headers", F.create_map().cast("map<string,string>"))
    path = in_files(full, str(tmp_path / "in"), "timestamp", 3)
    stream = stream_source(spark, StreamConfig(path=path, max_files_per_trigger=1), schemas.MESSAGES)
    out = str(tmp_path / "dq")
    window = {"window_ms": 3_600_000, "slide_ms": 1_800_000}
    windows = str(tmp_path / "windows")
    jobs.start_dq_windows(stream, windows, options(tmp_path), **window).awaitTermination()
    closed_windows = spark.readStream.schema(spark.read.parquet(windows).schema).parquet(windows)
    jobs.start_dq_flags(closed_windows, out, options(tmp_path)).awaitTermination()
    got = read_batches(spark, out)
    want = dq_windows.detect_anomalies(dq_windows.dq_window_metrics(messages, **window))
    end = got.agg(F.max("window_from")).first()[0]
    closed = want.where(F.col("window_from") <= F.lit(end))
    # The last windows stay open when the source is drained.
    assert 0 <= want.count() - closed.count() <= 20
    assert same(got, closed) > 100


def test_landing_splits_and_deduplicates(spark, tmp_path):
    good = '{"chain":"base","token_address":"0xA","price_usd":2.5,"timestamp":1700000000000}'
    rows = [
        ("market.prices", 0, 1, "k", good, 1_700_000_000_000),
        ("market.prices", 0, 1, "k", good, 1_700_000_001_000),
        ("market.prices", 0, 2, "k", good, 1_700_000_001_500),
        ("market.prices", 0, 3, "k", "{broken", 1_700_000_002_000),
        ("market.prices", 1, 4, "k", None, 1_700_000_003_000),
    ]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, timestamp bigint")
    path = str(tmp_path / "in")
    df.select("*", F.create_map().cast("map<string,string>").alias("headers"), F.lit(0).cast("bigint").alias("processing_time")).coalesce(1).write.parquet(path)
    stream = stream_source(spark, StreamConfig(path=path), schemas.MESSAGES)
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    jobs.start_landing(stream, schemas.PRICES, out, dead, landing.DEDUP_WINDOW["prices"], options(tmp_path)).awaitTermination()
    landed = read_batches(spark, out).collect()
    assert sorted((r.price_usd, r.kafka_offset) for r in landed) == [(2.5, 1), (2.5, 2)]
    assert {r.offset for r in read_batches(spark, dead).collect()} == {3, 4}


def test_percentile_state_grows_with_latencies_only(spark, tmp_path):
    """Fifty times the messages over the same hundred latencies: the state of the windows stays what it was."""

    def state_bytes(rows):
        at = F.lit(1_700_000_000_000) + F.col("id") % 1_000
        messages = spark.range(rows).select(
            F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("k").alias("key"), F.lit("v").alias("value"),
            at.alias("timestamp"), F.create_map().cast("map<string,string>").alias("headers"), (at + F.col("id") % 100).alias("processing_time"),
        )
        path = str(tmp_path / f"in{rows}")
        messages.coalesce(1).write.parquet(path)
        stream = stream_source(spark, StreamConfig(path=path), schemas.MESSAGES)
        query = jobs.start_dq_windows(stream, str(tmp_path / f"out{rows}"), options(tmp_path))
        query.awaitTermination()
        return max(o["memoryUsedBytes"] for p in query.recentProgress for o in p["stateOperators"])

    assert state_bytes(500_000) <= 1.2 * state_bytes(10_000)


def test_stream_percentiles_are_nearest_rank(spark, tmp_path):
    """Few messages, where neighbouring ranks differ most: each window's percentiles equal the batch form's."""
    rows = [("t", 0, i, "k", "v", 1_700_000_000_000 + i % 7 * 60_000, None, 1_700_000_000_000 + i % 7 * 60_000 + i * i) for i in range(300)]
    rows += [("t", 0, 999, "k", "v", 1_700_100_000_000, None, 1_700_100_000_000)]
    messages = spark.createDataFrame(rows, schemas.MESSAGES)
    messages.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stream_source(spark, StreamConfig(path=str(tmp_path / "in")), schemas.MESSAGES)
    jobs.start_dq_windows(stream, str(tmp_path / "out"), options(tmp_path)).awaitTermination()
    got = {r.window_from: (r.p95_latency_ms, r.p99_latency_ms) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.window_from: (r.p95_latency_ms, r.p99_latency_ms) for r in dq_windows.dq_window_metrics(messages).collect()}
    assert len(got) >= 8 and all(want[k] == v for k, v in got.items())


def test_sketches_unite_over_hours(spark):
    """Many addresses, each active in several hours: the day's distinct counts stay within three standard errors."""
    n = 60_000
    transfers = spark.range(n).select(
        F.lit("base").alias("chain"), F.lit("t").alias("token_address"), (F.col("id") % 20_000).cast("string").alias("from_address"), (F.col("id") % 40).cast("string").alias("to_address"),
        F.lit(1.0).alias("amount"), (F.lit(1_700_006_400_000) + F.col("id") % 20 * 3_600_000).alias("timestamp"),
    )
    hour = F.timestamp_millis(F.col("timestamp"))
    hourly = transfers.groupBy("chain", "token_address", hour.alias("hour")).agg(*flows.flow_measures(exact=False))
    day = flows.token_flow_daily(hourly).collect()
    assert len(day) == 1 and day[0].transfer_count == n and day[0].unique_receivers_count == 40
    assert abs(day[0].unique_senders_count - 20_000) <= 3 * flows.SKETCH_ERROR * 20_000


def test_broker_rows_become_messages(spark):
    rows = spark.sql("select 't' topic, 0 partition, 5L offset, cast('k' as binary) key, cast(null as binary) value, timestamp_millis(1700000000123) timestamp")
    got = envelope(rows)
    assert [f.name for f in got.schema] == ["topic", "partition", "offset", "key", "value", "timestamp", "headers", "processing_time"]
    r = got.first()
    assert (r.topic, r.partition, r.offset, r.key, r.value, r.timestamp, r.headers) == ("t", 0, 5, "k", None, 1_700_000_000_123, {})


def test_log_is_read_from_given_offsets(spark, tmp_path):
    rows = [(t, p, o, None, None, 0, None, 0) for t in "ab" for p in (0, 1) for o in range(4)]
    spark.createDataFrame(rows, schemas.MESSAGES).coalesce(1).write.parquet(str(tmp_path / "in"))
    config = StreamConfig(path=str(tmp_path / "in"), topics=("a",), starting_offsets='{"a": {"0": 3, "1": -2}, "b": {"0": 0}}')
    out = str(tmp_path / "out")
    jobs.start_prices(stream_source(spark, config), out, options(tmp_path)).awaitTermination()
    assert sorted((r.topic, r.partition, r.offset) for r in read_batches(spark, out).collect()) == [("a", 0, 3), *(("a", 1, o) for o in range(4))]
