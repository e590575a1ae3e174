"""The token flow's log: what a batch keeps, hours that several batches touch, late rows, and batches that are replayed."""

import os
import uuid

from pyspark.sql import functions as F

from oracle import flowing
from tidemark.config import HOUR_MS
from tidemark.operators import flows
from tidemark.streaming import flow, jobs, sinks
from tidemark.streaming.jobs import JobOptions

T0 = 1_700_006_400_000
VALUES = "'base' chain", "'t' token_address", "concat('0x', id) from_address", "concat('0y', id % 700) to_address", "if(id % 5 = 0, null, double(id % 10)) amount"


def test_a_transfer_is_kept_once_and_no_state_beside_it(spark, tmp_path):
    """Addresses that hardly repeat: the log has a row for each transfer, and the checkpoint holds no rows at all."""
    transfers = spark.range(3_000).selectExpr(*VALUES, f"{T0} + id * 2000 timestamp", "id extra")
    path, out, run = str(tmp_path / "in"), str(tmp_path / "flow"), JobOptions(run=uuid.uuid4().hex, available_now=True)
    transfers.write.parquet(path)
    jobs.start_token_flow(spark.readStream.schema(transfers.schema).parquet(path), out, run).awaitTermination()
    assert not [d for d, names, _ in os.walk(jobs._root(spark, run)) if "state" in names]
    log = flow.read_transfers(spark, out)
    assert log.count() == 3_000 and sorted(log.columns) == sorted(flow.FLOW_INPUT)
    assert flow.read_sides(spark, out).count() == 6_000


def test_batches_meet_and_are_replayed(spark, tmp_path):
    """Hours of two batches, one too late for its hour, one without rows, and each batch written twice."""
    rows = spark.range(4_000).selectExpr(*VALUES, f"{T0} + id * 5000 timestamp")
    late = spark.range(50).selectExpr(*VALUES, f"{T0} - {HOUR_MS} + id timestamp")
    nothing = rows.where("timestamp is null")
    parts = [rows.where("timestamp % 10000 = 0"), rows.where("timestamp % 10000 <> 0").unionByName(late), nothing, late]
    out = str(tmp_path / "flow")
    writer = flow.hourly_sink(out, str(tmp_path / "progress"), 5 * HOUR_MS)
    for batch_id, part in enumerate(parts):
        writer(part, batch_id)
        writer(part, batch_id)
    got = sinks.read_upserts(spark, out, flows.FLOW_KEY, "updated_at")
    want = flows.token_flow_hourly(rows, "2024-01-30")
    columns = [c for c in want.columns if c != "updated_at"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert flow.read_transfers(spark, out).count() == 4_000
    assert got.agg(F.max("updated_at") == F.timestamp_millis(F.lit(T0 + 3_999 * 5_000))).first()[0]


def test_a_batch_makes_only_its_own_hours(spark, tmp_path):
    """An hour that a batch doesn't touch is not written by it, though it lies between hours that it touches."""
    hour = lambda h: spark.range(10).selectExpr(*VALUES, f"{T0} + {h} * {HOUR_MS} + id timestamp")
    out = str(tmp_path / "flow")
    writer = flow.hourly_sink(out, str(tmp_path / "progress"), 10 * HOUR_MS)
    for batch_id, part in enumerate((hour(0).unionByName(hour(1)).unionByName(hour(2)), hour(0).unionByName(hour(2)))):
        writer(part, batch_id)
    written = {r.batch_id: r.n for r in spark.read.parquet(out).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert written == {0: 3, 1: 2}


def test_turns_write_only_what_the_flow_reads(spark, small, monkeypatch):
    """The stream of punctual transfers takes the columns of the flow, not hashes and texts of each transfer."""
    seen = []
    monkeypatch.setattr(flowing, "in_turns", lambda s, parts, *rest: seen.extend(p.columns for p in parts) or "")
    flowing._newest_first(spark, small, jobs.start_token_flow, flow.FLOW_INPUT)
    assert seen == [flow.FLOW_INPUT] * 2
