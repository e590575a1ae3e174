"""What only shows on larger tables: wide keys, many policies and rules, busy addresses, inputs of several files."""

from __future__ import annotations

import json
import operator
import random
import uuid
from collections import Counter

from pyspark.sql import functions as F

from oracle import flowing
from oracle.registry import ENTRIES
from tidemark.operators import behaviour, flows, policies
from tidemark.streaming import flow, jobs, sinks
from tidemark.streaming.jobs import JobOptions


def large_orders(spark, path, first=150_000 * 60):
    """An orders table with keys as they are at sixty times the largest given one."""
    rows = [(first + i, 1 + i, 1000.25 + i) for i in range(40)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double").write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_account_data_of_large_keys(spark, tmp_path):
    """The fixed-point health factor passes 64 bits, as the contract's 256-bit number does."""
    got = {r.block_number: r for r in ENTRIES["scale_positions"].run(spark, large_orders(spark, tmp_path)).collect()}
    for i in range(40):
        key = 150_000 * 60 + i
        if key % 12:
            assert got[key + 1].health_factor == float(key * 10**14) / 1e18
    assert len(got) == 40 - len([i for i in range(40) if (150_000 * 60 + i) % 12 == 0])


def test_policies_share_passes_but_not_clocks(spark, monkeypatch):
    """Many policies in several blocks, names that repeat, null addresses: as a walk over each policy and address."""
    monkeypatch.setattr(policies, "BLOCK", 40)
    monkeypatch.setattr(policies, "PIECE", 7)
    rng = random.Random(21)
    rules = [(f"p{i % 110}", rng.choice("mn"), rng.choice(["<", "<=", ">", ">="]), rng.randint(0, 12) / 4, rng.choice([0, 0, 1, 5])) for i in range(120)]
    configs = [(n, json.dumps({"metric": m, "operator": o, "threshold": t, "cooldown_minutes": c}), True) for n, m, o, t, c in rules]
    seen = [(rng.choice("mno"), "base", rng.choice(["0x1", "0x2", "0x3", None]), 1_700_000_000_000 + 20_000 * rng.randint(0, 80), rng.choice([None, float("nan"), rng.randint(0, 12) / 4]), f"r{i}") for i in range(400)]
    observed = spark.createDataFrame(seen, "metric string, chain string, address string, at bigint, value double, ref string")
    got = Counter((r.policy, r.address, r.ref) for r in policies.policy_alerts(observed.repartition(7), spark.createDataFrame(configs, "name string, config string, enabled boolean")).collect())
    compare = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
    want, last = Counter(), {}
    for metric, _, address, at, value, ref in sorted(seen, key=lambda s: (s[3], s[5])):
        for name, m, o, t, c in sorted(rules, key=lambda r: r[1:]):
            if m == metric and value is not None and value == value and compare[o](value, t) and at - last.get((name, address), -(10**15)) >= c * 60_000:
                last[name, address] = at
                want[name, address, ref] += 1
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5], [r for r in rules if r[0] in {k[0] for k in (got - want)}][:6])
    assert sum(want.values()) > 1_500


def test_policy_crossings_are_not_shuffled(spark):
    """Sixty times the policies on the same observations: the result grows, what is shuffled does not grow with it."""
    seen = spark.range(2_000).selectExpr("'m' metric", "'base' chain", "concat('0x', id % 50) address", "id * 1000 at", "double(id % 100) value", "string(id) ref")
    configs = spark.range(600).selectExpr("concat('p', id) name", """concat('{"metric":"m","operator":">","threshold":', id % 10, '}') config""", "true enabled")
    alerts = policies.policy_alerts(seen, configs)
    assert alerts.count() > 1_000_000
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.index("MapInArrow") < plan.index("Exchange")


def test_watch_matches_come_once_and_unshuffled(spark):
    """Repeated events and rules, rules under several keys, bounds in many cells: as nested loops; the rest isn't compared."""
    rng = random.Random(22)
    kinds = {"level": "AB", "token": ["X", "Y", "*"], "sent": ["0x1", "0x2", "0x3"], "health": ["0x1", "0x2"], "alert": ["0x1", "0x2"]}
    index = []
    for i in range(150):
        kind = rng.choice(list(kinds))
        bound = rng.randint(0, 30) * 1.0 if kind in ("level", "token") else 0.0
        for key in rng.sample(list(kinds[kind]), rng.choice([1, 1, 2])):
            index.append((f"r{i % 140}", "u", kind, key, rng.choice([1, 1, 2]), bound, rng.choice([1.0, 1.5]) if kind == "health" else None))
    events = []
    for i in range(300):
        kind = rng.choice(list(kinds))
        keys = [rng.choice(["X", "Y", "Z"]), "*"] if kind == "token" else rng.sample(["0x1", "0x2", "0x3"], 2) if kind == "sent" else [rng.choice(list(kinds[kind]))]
        events.append((f"e{i % 280}", kind, keys, rng.choice([1, 2]), float(rng.randint(0, 35)), rng.choice([0.9, 1.2, None])))
    want = {(r[0], r[2], e[0]) for r in index for e in events if r[2] == e[1] and r[3] in e[2] and e[3] >= r[4] and e[4] >= r[5] and (r[2] != "health" or (e[5] is not None and e[5] < r[6]))}
    frames = (
        spark.createDataFrame(events, "event string, kind string, keys array<string>, rank bigint, usd double, value double"),
        spark.createDataFrame(index, "rule string, user_id string, kind string, key string, least_rank bigint, least_usd double, below double"),
    )
    matches = policies.watch_matches(*frames)
    got = sorted((r.rule, r.kind, r.event) for r in matches.collect())
    assert got == sorted(want) and len(got) > 1_000
    plan = matches._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert plan[0].startswith("Union") and plan[1].lstrip(":+- ").startswith("Project")


def test_streamed_hours_count_addresses_exactly(spark, tmp_path):
    """Far more addresses in an hour than a sketch of 4 KiB lists, some in both of two batches."""
    transfers = spark.range(40_000).selectExpr(
        "'base' chain", "'t' token_address", "if(id % 1000 = 7, null, concat('0x', id % 9001)) from_address", "concat('0x', id % 7003) to_address", "double(id % 10) amount",
        "1700006400000 + id * 180 timestamp",
    )
    path, out, run = str(tmp_path / "in"), str(tmp_path / "flow"), JobOptions(run=uuid.uuid4().hex, available_now=True)
    for part in ("timestamp % 3 = 0", "timestamp % 3 <> 0"):
        transfers.where(part).write.mode("append").parquet(path)
        jobs.start_token_flow(spark.readStream.schema(transfers.schema).parquet(path), out, run).awaitTermination()
    got = sinks.read_upserts(spark, out, flows.FLOW_KEY, "updated_at").drop("updated_at")
    want = flows.token_flow_hourly(transfers, "2024-01-30").drop("updated_at")
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    whole = flows.token_flow_of(flow.read_sides(spark, out), ["chain", "token_address"]).first()
    assert (whole.transfer_count, whole.unique_senders_count, whole.unique_receivers_count) == (40_000, 9001, 7003)


def test_parts_are_written_by_all_their_tasks(spark):
    """Two parts of four partitions each: two batches, in order, and no part goes through one task."""
    rows = spark.range(0, 400, 1, 4).selectExpr("'0xt' tx_hash", "int(id) log_index", "id timestamp")
    parts = [rows.where("timestamp >= 200").repartition(4), rows.where("timestamp < 200").repartition(4)]
    out = flowing.in_turns(spark, parts, {}, "tx_hash string, log_index int, timestamp bigint", jobs.start_prices)
    batches = spark.read.parquet(out).groupBy("batch_id").agg({"timestamp": "min"}).orderBy("batch_id").collect()
    assert [tuple(b) for b in batches] == [(0, 200), (1, 0)]
    assert spark.read.parquet(out).count() == 400
    assert spark.read.parquet(out).select(F.input_file_name()).distinct().count() > 2


def test_behaviour_shuffles_few_sums_beside_its_rows(spark):
    """Addresses with a moment every three hours: what lies before a row's bucket comes from a few rows, not one for each moment."""
    rows = spark.range(6_000).selectExpr(
        "'base' chain", "concat('0x', id % 40) address", "1700000000000 + id div 40 * 10800000 at", "cast(id % 7 as decimal(38,8)) usd", "'t' token", "'p' protocol"
    )
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def written():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = written()
    features = behaviour.behaviour_features(rows, "2024-01-30").collect()
    assert len(features) == 6_000 and max(r.tx_count_7d for r in features) == 56
    assert written() - before < 95_000
