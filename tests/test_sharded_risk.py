"""The risk stream keeps the state of many users in one row."""

from pyspark.sql import functions as F

from tidemark.operators import risk as batch
from tidemark.streaming import jobs, risk, sinks
from tidemark.streaming.jobs import JobOptions


def test_users_of_one_shard_keep_their_own_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(risk, "SHARDS", 1)
    rows = spark.range(400).selectExpr(
        "'base' chain", "'p' protocol", "if(id % 7 = 0, null, concat('u', id % 7)) user_address", "id block_number", "1.0D + (id * 37 % 60) / 50D health_factor",
        "cast(1e6 as decimal(38,8)) total_collateral_usd", "cast(5e5 as decimal(38,8)) total_debt_usd", "cast(0 as decimal(38,8)) available_borrow_usd",
        "0.75D ltv", "0.8D liquidation_threshold", "1700000000000 + id * 600000 timestamp",
    )
    halves = [rows.where("block_number < 200"), rows.where("block_number >= 200")]
    for half in halves:
        half.repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        jobs.start_risk(stream, str(tmp_path / "metrics"), str(tmp_path / "alerts"), JobOptions(run=tmp_path.name, available_now=True)).awaitTermination()
    got = sinks.read_batches(spark, str(tmp_path / "metrics"))
    keys = ["user_address", "block_number", "risk_level", "previous_risk_level"]
    assert got.count() == 400
    want = batch.risk_metrics(rows.where(F.col("user_address").isNotNull())).select(keys)
    assert sorted(map(tuple, got.where(F.col("user_address").isNotNull()).select(keys).collect())) == sorted(map(tuple, want.collect()))
