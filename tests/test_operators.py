"""Edge rules on hand-made rows, checked against plain Python where a rule is sequential."""

import json
import operator
import random
from collections import Counter
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.config import DEBOUNCE_MS, RISK_LEVELS, STATE_TTL_MS
from tidemark.functions.addresses import ZERO_ADDRESS, is_valid_address, truncate_address
from tidemark.functions.risk import risk_level, size_tier, utilization
from tidemark.functions.values import number_text
from tidemark.operators import behaviour, chain, checks, flows, lending, metrics, policies, risk, timeline, versions, whales
from tidemark.operators.behaviour import WEEK_MS
from tidemark.operators.dq_windows import FRESH_STATS, detector_step, dq_window_metrics
from tidemark.operators.staging import stg_lending_events, stg_transfers
from tidemark.plans import marts, serving
from tidemark.sources import logs, records, schemas
from tidemark.sources.raw import conform
from tidemark.session import cut_lineage

T0 = 1_700_000_000_000


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def level_of(health):
    for floor, level in zip((2.0, 1.5, 1.2, 1.0), RISK_LEVELS):
        if health >= floor:
            return level
    return "LIQUIDATABLE"


@pytest.mark.parametrize(
    "health,level",
    [(2.0, "SAFE"), (1.999, "WARNING"), (1.5, "WARNING"), (1.2, "DANGER"), (1.0, "CRITICAL"), (0.999, "LIQUIDATABLE")],
)
def test_risk_level_bounds(spark, health, level):
    assert one(spark, risk_level(F.lit(health)))[0] == level


def test_risk_level_is_monotone(spark):
    df = spark.range(400).select((F.col("id") / 100).alias("h"))
    ranks = [RISK_LEVELS.index(r[0]) for r in df.select(risk_level(F.col("h")), "h").orderBy("h").collect()]
    assert ranks == sorted(ranks, reverse=True)


def test_tiers_and_utilization(spark):
    got = one(
        spark,
        *[size_tier(F.lit(v)) for v in (1_000_000, 999_999.99, 100_000, 10_000, 9_999)],
        utilization(F.lit(Decimal("5")), F.lit(Decimal("0"))),
        utilization(F.lit(Decimal("1")), F.lit(Decimal("3"))),
    )
    assert list(got) == ["whale", "large", "large", "medium", "small", 0.0, 1 / 3]


def test_address_helpers(spark):
    full = "0x" + "aB" * 20
    got = one(
        spark,
        truncate_address(F.lit(full)),
        truncate_address(F.lit("0x12")),
        truncate_address(F.lit("0x1234567"), guard=False),
        is_valid_address(F.lit(full)),
        is_valid_address(F.lit("0x" + "zz" * 20)),
        is_valid_address(F.lit("0x" + "zz" * 20), strict=False),
    )
    assert list(got) == ["0xaBaB...aBaB", "0x12", "0x1234...4567", True, False, True]


def test_number_text(spark):
    values = [0.0, 23.0, 68423.46, 4.9e-11, 12345678.5, 1e25]
    got = one(spark, *[number_text(F.lit(v)) for v in values])
    assert list(got) == ["0", "23", "68423.46", "0.000000000049", "12345678.5", "1.0E25"]


# --- sources ----------------------------------------------------------------


def test_conform_accepts_both_spellings_and_times(spark):
    df = spark.createDataFrame(
        [("0xB", "usdc", 1.5, "2023-11-14T22:13:20Z"), ("0xC", None, 2.5, str(T0))],
        "asset_address string, asset_symbol string, price_usd double, timestamp string",
    )
    rows = conform(df, schemas.PRICES).orderBy("token_address").collect()
    assert [(r.token_address, r.token_symbol, r.timestamp, r.chain) for r in rows] == [
        ("0xB", "usdc", T0, None),
        ("0xC", None, T0, None),
    ]


def test_parsers_default_and_ignore_broken(spark):
    df = spark.createDataFrame(
        [('{"user_address":"0x1","timestamp":"2023-11-14T22:13:20Z"}',), ("{broken",), (None,)], "value string"
    )
    rows = [r for r in records.parse_positions(df).collect() if r.timestamp is not None]
    assert len(rows) == 1
    r = rows[0]
    assert (r.chain, r.protocol, r.health_factor, r.ltv, r.total_debt_usd, r.timestamp) == (
        "base", "aave_v3", 999.0, 0.0, Decimal(0), T0,
    )


def word(value):
    return format(value, "064x")


def test_decode_full_range_numbers(spark):
    values = [0, 1, 2**60 - 1, 2**60, 2**63, 10**27 + 7, 2**200 + 12345, 2**256 - 1]
    topics = [logs.TRANSFER_TOPIC, "0x" + word(1), "0x" + word(2)]
    df = spark.createDataFrame(
        [("0xT", topics, "0x" + word(v), 1, "0xh", i, T0) for i, v in enumerate(values)]
        + [("0xT", topics[:2], "0x" + word(5), 1, "0xh", 99, T0)],
        schemas.LOGS,
    )
    rows = logs.decode_transfers(df).orderBy("log_index").collect()
    assert [r.amount_raw for r in rows] == [str(v) for v in values]
    assert rows[0].from_address == "0x" + "1".zfill(40)


def test_decode_equals_python_integers(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(rng.randint(1, 256)) for _ in range(1000)]
    values += [10 ** rng.randint(9, 60) * rng.randint(1, 10**15) - 1 for _ in range(1000)]
    df = spark.createDataFrame([(i, word(v)) for i, v in enumerate(values)], "i int, w string").select("i", logs.uint_value(F.col("w")).alias("v"))
    assert [r.v for r in df.orderBy("i").collect()] == [str(v) for v in values]


def test_decode_skips_unknown_topics(spark):
    df = spark.createDataFrame(
        [("0xP", [t, "0x" + word(7), "0x" + word(8), "0x" + word(9)], "0x" + word(3) + word(4) + word(5), 1, "0xh", i, T0)
         for i, t in enumerate([logs.LIQUIDATION_TOPIC, logs.TRANSFER_TOPIC, "0xother"])],
        schemas.LOGS,
    )
    (r,) = logs.decode_lending_events(df).collect()
    assert (r.event_type, r.amount, r.debt_to_cover) == ("LIQUIDATION", "4", "3")
    assert r.user_address == "0x" + "9".zfill(40) and r.asset_address == "0x" + "8".zfill(40)
    assert r.liquidator_address == "0x" + "5".zfill(40) and r.collateral_asset == "0x" + "7".zfill(40)


def test_amount_beyond_decimal_keeps_text(spark):
    df = conform(
        spark.createDataFrame([("base", str(2**256 - 1), T0)], "chain string, amount string, timestamp bigint"),
        schemas.LENDING_EVENTS,
    )
    (r,) = stg_lending_events(df).collect()
    assert r.amount_raw is None and r.amount_text == str(2**256 - 1)


# --- flows ------------------------------------------------------------------


def transfers(spark, rows):
    """rows: (id, token, symbol, from, to, usd, ms)"""
    df = spark.createDataFrame(
        [(i, "base", t, s, 18, a, b, "0", u, u, 1, "0xh", 0, ms) for i, t, s, a, b, u, ms in rows], schemas.TRANSFERS
    )
    return stg_transfers(df)


def naive_netflow(rows):
    """The outer join written out: group each side by symbol, pair all symbols of a key."""
    sides = {"in": {}, "out": {}}
    for _, token, symbol, sender, receiver, usd, ms in rows:
        day = datetime.fromtimestamp(ms / 1000, timezone.utc).date()
        kind = "mint" if sender == ZERO_ADDRESS else "burn" if receiver == ZERO_ADDRESS else "transfer"
        if kind != "burn":
            sides["in"].setdefault((day, receiver, token), {}).setdefault(symbol.upper(), []).append(usd)
        if kind != "mint":
            sides["out"].setdefault((day, sender, token), {}).setdefault(symbol.upper(), []).append(usd)
    result = []
    for key in set(sides["in"]) | set(sides["out"]):
        if key[1] == ZERO_ADDRESS:
            continue
        ins = list(sides["in"].get(key, {}).items()) or [(None, [])]
        outs = list(sides["out"].get(key, {}).items()) or [(None, [])]
        for i_symbol, i in ins:
            for o_symbol, o in outs:
                result.append((*key, i_symbol or o_symbol, len(i), sum(i), len(o), sum(o)))
    return sorted(result)


def test_netflow_pairs_symbols_like_an_outer_join(spark):
    rng = random.Random(3)
    people = [ZERO_ADDRESS, "0xa", "0xb", "0xc", "0xd"]
    rows = []
    for i in range(400):
        hot = rng.random() < 0.4
        sender = "0xa" if hot else rng.choice(people)
        rows.append((str(i), rng.choice(["0xt1", "0xt2", "0xt3"]), rng.choice(["x", "y", "z"]), sender,
                     rng.choice(people), float(rng.randint(1, 9)), T0 + rng.randint(0, 3) * 86_400_000))
    got = flows.address_netflow_daily(transfers(spark, rows), "2024-01-01").select(
        "event_date", "address", "token_address", "token_symbol", "inflow_count", "inflow_usd", "outflow_count", "outflow_usd"
    )
    assert sorted(tuple(r) for r in got.collect()) == naive_netflow(rows)


def test_netflow_totals_equal_transfers(spark):
    rows = [(str(i), "0xt", "s", f"0x{i % 7}", f"0x{i % 5}", 2.0, T0 + i) for i in range(100)]
    rows += [("m", "0xt", "s", ZERO_ADDRESS, "0x1", 3.0, T0), ("b", "0xt", "s", "0x1", ZERO_ADDRESS, 5.0, T0)]
    total = flows.address_netflow_daily(transfers(spark, rows), "2024-01-01").agg(
        F.sum("inflow_usd"), F.sum("outflow_usd")
    ).first()
    assert tuple(total) == (203.0, 205.0)


def test_ohlc_orders_equal_times_by_value(spark):
    day = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(date(2024, 1, 1), "0xt", day, 5.0), (date(2024, 1, 1), "0xt", day, 3.0), (date(2024, 1, 1), "0xt", day, 4.0)],
        "price_date date, token_address string, price_timestamp timestamp, price_usd double",
    )
    (r,) = flows.daily_ohlc(df).collect()
    assert (r.open_price_usd, r.close_price_usd) == (3.0, 5.0)


def test_flash_loans_fill_no_pivot_column(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), "p", "flash_loan", 4, 2, 9.0)],
        "metrics_date date, protocol string, event_type string, event_count bigint, unique_users bigint, volume_usd double",
    )
    (r,) = lending.event_pivot(df).collect()
    assert r.total_active_users == 2
    assert sum(r[f"{e}_count"] for e in lending.PIVOTED_EVENTS) == 0


# --- whales, marts, serving -------------------------------------------------


def test_whale_with_two_positions_lists_its_type_twice(spark):
    held = spark.createDataFrame(
        [("0xa", Decimal("2000000")), ("0xa", Decimal("3000000")), ("0xa", Decimal("3000000"))],
        "user_address string, total_collateral_usd decimal(38,8)",
    )
    sent = transfers(spark, [("1", "0xt", "s", "0xa", "0xb", 1_000_000.0, T0)])
    (r,) = whales.whale_addresses(held, sent, "2023-11-20").collect()
    assert r.whale_types == ["position_whale", "position_whale", "transfer_whale"]
    assert (r.whale_type_count, r.max_whale_value_usd) == (3, 3_000_000.0)
    moves = whales.whale_movements(
        transfers(spark, [
            ("1", "0xt", "s", "0xa", "0xa", 10_000.0, T0),
            ("2", "0xt", "s", "0xb", "0xa", 10_000.0, T0),
            ("3", "0xt", "s", "0xb", "0xa", 9_999.99, T0),
            ("4", "0xt", "s", "0xb", "0xc", 50_000.0, T0),
        ]),
        spark.createDataFrame([("0xa",)], "address string"),
        "2024-01-01",
    )
    assert sorted((m.movement_id, m.whale_direction) for m in moves.collect()) == [("1", "whale_out"), ("2", "whale_in")]


POSITION_ROWS = "chain string, protocol string, user_address string, risk_level string, position_size_tier string, health_factor double, total_collateral_usd decimal(38,8), total_debt_usd decimal(38,8)"


def test_empty_tables_give_the_documented_defaults(spark):
    none = spark.createDataFrame([], POSITION_ROWS)
    (k,) = marts.ecosystem_kpis(none, transfers(spark, []), "2024-01-01").collect()
    assert (k.total_positions, k.total_tvl, k.volume_24h, k.transfers_24h) == (0, Decimal(0), 0.0, 0)
    assert k.active_users_24h is None and k.avg_health_factor is None
    lines = {r.metric_name: r.metric_value for r in marts.risk_dashboard(none, "2024-01-01").collect()}
    assert lines == {"total_users": "0", "total_tvl_usd": None, "total_debt_usd": None, "avg_health_factor": None}
    assert flows.address_netflow_daily(transfers(spark, []), "2024-01-01").count() == 0


def test_serving_defaults_and_rejects(spark):
    assert serving.given(-1, 100) == 100 and serving.given(None, 100) == 100 and serving.given(5000, 100) == 5000
    with pytest.raises(ValueError):
        serving.checked_address("0x12")
    rows = spark.createDataFrame(
        [("base", "0xa", "p", 1.1, "CRITICAL", Decimal(1000), Decimal(1), 1, 1),
         ("base", "0xb", "p", 1.05, "CRITICAL", Decimal("999.99"), Decimal(1), 1, 1),
         ("base", "0xa", "p", 1.3, "DANGER", Decimal(1000), Decimal(1), 0, 0)],
        "chain string, user_address string, protocol string, health_factor double, risk_level string, total_collateral_usd decimal(38,8), total_debt_usd decimal(38,8), block_number bigint, version bigint",
    )
    rows = conform(rows, schemas.RISK_METRICS)
    assert [r.address for r in serving.high_risk(rows, "SAFE", None, -5).collect()] == ["0xa"]


# --- versions ---------------------------------------------------------------


def test_latest_version_is_the_same_for_any_split(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randint(0, 5) if rng.random() < 0.6 else 0}", rng.randint(0, 40), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, version bigint, x double")
    whole = versions.latest_version(df, ["k"], "version").collect()
    parts = [versions.latest_version(spark.createDataFrame(rows[i::3], df.schema), ["k"], "version") for i in range(3)]
    merged = versions.latest_version(parts[0].union(parts[1]).union(parts[2]), ["k"], "version").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, merged))
    best = {}
    for k, v, x in rows:
        best[k] = max(best.get(k, (-1, -1.0)), (v, x))
    assert sorted((k, *b) for k, b in best.items()) == sorted(map(tuple, whole))
    plan = versions.latest_version(df, ["k"], "version")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# --- risk timeline ----------------------------------------------------------


def positions(spark, rows):
    return spark.createDataFrame(
        [("base", p, u, b, h, Decimal(1), Decimal(1), Decimal(1), 0.5, 0.5, None, None, ms, None, None) for u, p, b, h, ms in rows],
        schemas.POSITIONS,
    )


def walk(rows):
    """The state machine, one user at a time."""
    out, alerts, state, last = [], [], {}, {}
    for u, p, b, h, ms in sorted(rows, key=lambda r: (r[0], r[4], r[2], r[1], r[3])):
        level, old = level_of(h), state.get(u)
        if old and ms - old["at"] >= STATE_TTL_MS:
            old = None
        if old is None:
            previous, since = level, ms
        elif old["level"] != level:
            previous, since = old["level"], ms
        else:
            previous, since = old["previous"], old["since"]
        if old:
            up = RISK_LEVELS.index(level) - RISK_LEVELS.index(old["level"])
            drop = old["h"] > 0 and (old["h"] - h) / old["h"] > 0.2
            if (up > 0 or (up < 0 and level == "SAFE") or drop) and ms - last.get(u, 0) >= DEBOUNCE_MS[level]:
                alerts.append((u, b, p, ms))
                last[u] = ms
        state[u] = {"level": level, "previous": previous, "since": since, "h": h, "at": ms}
        out.append((u, b, p, level, previous, since))
    return sorted(out), sorted(alerts)


@pytest.mark.parametrize("levels", [(0.5, 3.0), (1.05, 3.0)])
def test_busy_user_equals_plain_walk(spark, levels):
    """One user holds most rows, seconds apart, over bucket borders; with and
    without levels that reset the debounce clock."""
    rng = random.Random(11)
    rows, ms = [], T0
    for b in range(700):
        ms += rng.choice([2_000, 15_000, 45_000, 59_999, 60_000, 300_000, 400_000])
        rows.append(("0xhot", "p", b, rng.uniform(*levels), ms))
    for u in range(40):
        ms = T0
        for b in range(6):
            ms += rng.choice([10_000, 3_600_000, STATE_TTL_MS, STATE_TTL_MS - 1, 86_400_000])
            rows.append((f"0x{u}", rng.choice("pq"), b, rng.uniform(*levels), ms))
    df = positions(spark, rows)
    want_rows, want_alerts = walk(rows)
    for day in (86_400_000, 600_000):
        moved = risk.risk_transitions(df, bucket_ms=day)
        got = moved.select("user_address", "block_number", "protocol", "risk_level", "previous_risk_level", "risk_changed_ms")
        assert sorted(map(tuple, got.collect())) == want_rows
        sent = risk.debounce(risk.alert_candidates(moved))
        got = sent.select("user_address", "block_number", "protocol", "event_ms")
        assert sorted(map(tuple, got.collect())) == want_alerts
    assert len(want_alerts) > 100


def test_spacing_boundary_and_limits(spark):
    df = spark.createDataFrame([("k", T0 + x, 60_000, x) for x in (0, 59_999, 60_000, 119_999, 120_000)], "k string, t bigint, gap int, id int")
    kept = timeline.keep_spaced(df, ["k"], "t", "gap", ["id"])
    assert sorted(r.id for r in kept.collect()) == [0, 60_000, 120_000]
    assert kept.columns == df.columns


def fold(rows):
    """Kept rows of (key, at, gap, id), one after the other."""
    last, kept = {}, []
    for key, at, gap, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[3])):
        if key not in last or at - last[key] >= (gap or 0):
            last[key] = at
            kept.append(i)
    return sorted(kept)


def test_spacing_equals_a_plain_fold(spark):
    rng = random.Random(6)
    rows, i = [], 0
    for key in ("a", "b", None, "c"):
        at = T0
        for _ in range(400):
            at += rng.choice([0, 1, 999, 1_000, 5_000, 59_999, 60_000, 400_000, 90_000_000])
            rows.append((key, at, rng.choice([0, None, 1_000, 60_000, 300_000, 100_000_000]), i))
            i += 1
    df = spark.createDataFrame(rows, "k string, t bigint, gap bigint, id int").repartition(7)
    for bucket in (86_400_000, 60_000):
        kept = timeline.keep_spaced(df, ["k"], "t", "gap", ["id"], bucket)
        assert sorted(r.id for r in kept.collect()) == fold(rows)


def test_rows_without_a_time_are_not_spaced(spark):
    df = spark.createDataFrame([("k", None, 5, 1), ("k", T0, 5, 2)], "k string, t bigint, gap bigint, id int")
    assert [r.id for r in timeline.keep_spaced(df, ["k"], "t", "gap", ["id"]).collect()] == [2]
    assert timeline.keep_spaced(df.limit(0), ["k"], "t", "gap", ["id"]).collect() == []


def test_busy_key_is_folded_in_many_tasks(spark):
    """A million rows of one key, in bursts: no task takes more than a fraction, and the rows are those of one fold."""
    n, burst = 1_000_000, 2_000
    at = F.lit(T0) + F.floor(F.col("id") / burst) * 3_600_000 + (F.col("id") % burst) * 700
    df = spark.range(n).select(F.lit("hot").alias("k"), at.alias("t"), F.lit(300_000).alias("gap"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = timeline.keep_spaced(df, ["k"], "t", "gap", ["id"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # Within a burst of 1,399.3 s every 429th row is kept: 300,000 ms are 428.6 steps of 700.
    assert sorted(r.id for r in kept) == [b * burst + k for b in range(n // burst) for k in range(0, burst, 429)]
    shares = Counter(r.task for r in kept)
    assert len(shares) > 1 and max(shares.values()) < len(kept) / 2


def test_spacing_deals_by_segment(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as t", "3L as gap", "id")
    plan = timeline.keep_spaced(df, ["k"], "t", "gap", ["id"])._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 1 and "_segment" in dealt[0]
    assert plan.count("Range (") == 2  # rows, and their summary by bucket


def test_running_totals(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), T0 + rng.randint(0, 50) * 600_000, rng.randint(-5, 5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, t bigint, x bigint")
    got = timeline.running(df, ["k"], "t", ["x"]).collect()
    want = sorted((k, t, sum(x for k2, t2, x in rows if k2 == k and t2 <= t)) for k, t, _ in rows)
    assert sorted(map(tuple, got)) == want


def test_latest_values(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), T0 + rng.randint(0, 80) * 900_000, rng.choice([None, None, 1.0, 2.0, 3.0]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t bigint, v double, id int")
    for r in timeline.latest(df, ["k"], "t", "v").collect():
        before = [(t, v) for k, t, v, _ in rows if k == r.k and t <= r.t and v is not None]
        assert r.v == (max(before)[1] if before else None)


def test_alert_routing(spark):
    alerts = spark.createDataFrame(
        [("1", "0xA", "HIGH", "RISK_INCREASED"), ("2", "0xb", "INFO", "RISK_DECREASED")],
        "alert_id string, user_address string, severity string, alert_type string",
    )
    configs = spark.createDataFrame(
        [("u1", "0xa", "WARNING", None), ("u2", None, "INFO", None), ("u3", None, "CRITICAL", None), ("u4", "0xb", "INFO", ["LIQUIDATION_RISK"])],
        "user_id string, address string, min_severity string, alert_types array<string>",
    )
    got = sorted((r.user_id, r.alert_id) for r in risk.route_alerts(alerts, configs).collect())
    assert got == [("u1", "1"), ("u2", "1"), ("u2", "2")]


# --- message quality --------------------------------------------------------


def test_percentiles_are_nearest_rank(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        ms = T0 + rng.randint(0, 120_000)
        rows.append(("hot" if i % 3 else "cold", 0, i, "k", "v" if i % 10 else " ", ms, None, ms + rng.randint(0, 90_000)))
    got = {(r.topic, r.window_from): r for r in dq_window_metrics(spark.createDataFrame(rows, schemas.MESSAGES)).collect()}
    for (topic, start), r in got.items():
        begin = int(start.timestamp() * 1000)
        inside = [x for x in rows if x[0] == topic and begin <= x[5] < begin + 60_000]
        late = sorted(x[7] - x[5] for x in inside)
        rank = lambda p: late[max(0, -(-int(p * 100) * len(late) // 100) - 1)]
        assert r.message_count == len(inside)
        assert r.null_count == sum(x[4] == " " for x in inside)
        assert r.late_arrival_count == sum(v > 60_000 for v in late)
        assert (r.p95_latency_ms, r.p99_latency_ms, r.max_latency_ms) == (rank(0.95), rank(0.99), late[-1])


def test_detector_stays_quiet_in_warm_up():
    stats = FRESH_STATS
    for _ in range(10):
        stats, rate, latency = detector_step(stats, 5.0, 100.0)
        assert not rate and not latency
    _, rate, latency = detector_step(stats, 50.0, 100.0)
    assert rate and not latency


# --- chain ------------------------------------------------------------------


def test_chain_checks(spark):
    blocks = spark.createDataFrame(
        [(1, "h1", "h0"), (2, "h2", "h1"), (3, "h3", "bad"), (6, "h6", "h5")], "block_number bigint, block_hash string, parent_hash string"
    )
    assert [r.block_number for r in chain.parent_mismatches(blocks).collect()] == [3]
    assert [(r.missing_block, r.block_number) for r in chain.block_gaps(blocks).collect()] == [(5, 6)]
    assert sorted(r.block_number for r in chain.confirmed(blocks, 4).collect()) == [1, 2]
    assert chain.confirmed(blocks, 100).count() == 0
    points = spark.createDataFrame(
        [("a", 2, "h2"), ("b", 3, "old"), ("c", 2, ""), ("d", 4, "h4"), ("e", 0, None)], "indexer string, last_block bigint, block_hash string"
    )
    got = {r.indexer: (r.status, r.start_block) for r in chain.verify_checkpoint(points, blocks, 4).collect()}
    assert got == {
        "a": ("verified", 3), "b": ("hash_mismatch", 2), "c": ("unverified", 3), "d": ("block_missing", 2), "e": ("no_checkpoint", 2),
    }
    assert {r.start_block for r in chain.verify_checkpoint(points, blocks, 4, start_block=9).collect()} == {9}


def test_poll_tiers(spark):
    latest = spark.createDataFrame([("a", 1.1), ("b", 1.4), ("c", 3.0), ("d", 3.0)], "user_address string, health_factor double")
    active = spark.createDataFrame([("a", T0), ("c", T0), ("e", T0 - 90_000_000)], "user_address string, last_active_ms bigint")
    got = {r.user_address: (r.tier, r.severity) for r in chain.poll_tiers(latest, active, datetime.fromtimestamp(T0 / 1000, timezone.utc)).collect()}
    assert got == {"a": ("high_risk", "critical"), "b": ("high_risk", "warning"), "c": ("active", None), "e": ("inactive", None)}


# --- checks and metrics -----------------------------------------------------


def test_checks_on_empty_and_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-1.0,)], "x double")
    assert [r.invalid_value for r in checks.positive_value(df, "x").collect()] == [-1.0]
    assert checks.not_null(df, "x").count() == 1
    assert checks.unique(spark.createDataFrame([(None,), (None,)], "x int"), "x").count() == 0
    empty = spark.createDataFrame([], "t timestamp, a int, b int")
    assert checks.freshness(empty, "t", 300, "2024-01-01", "n").first().failed is True
    assert checks.completeness(empty, ["a", "b"], "n").count() == 0
    assert checks.recent_data(empty, "t", "2024-01-01").count() == 0


def test_metrics_share_one_pass_and_guard_names(spark):
    df = spark.createDataFrame(
        [("base", "p", "a", "SAFE", "whale", 2.0, Decimal(30), Decimal(3)), ("base", "p", "b", "CRITICAL", "small", 1.0, Decimal(10), Decimal(5)),
         ("base", "q", "c", "SAFE", "small", 2.0, Decimal(0), Decimal(0))],
        POSITION_ROWS,
    ).withColumn("position_key", F.col("user_address"))
    models = {"address_positions": df}
    got = metrics.metrics(models, ["whale_tvl_share", "at_risk_ratio", "total_positions"], ("protocol",))
    rows = {r.protocol: (r.whale_tvl_share, r.at_risk_ratio, r.total_positions) for r in got.collect()}
    assert rows == {"p": (0.75, 0.25, 2), "q": (None, None, 1)}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    alone = metrics.metric(models, "whale_tvl_usd", ("protocol",)).collect()
    both = metrics.metrics(models, ["whale_tvl_usd", "at_risk_tvl_usd"], ("protocol",)).collect()
    assert [tuple(r) for r in alone] == [("p", 30)] and [tuple(r) for r in both] == [("p", 30, 10)]
    with pytest.raises(ValueError):
        metrics.metric(models, "total_tvl_usd", ("nope",))
    with pytest.raises(ValueError):
        metrics.metrics(models, ["total_tvl_usd", "total_transfers"])


def test_lineage_is_cut_in_the_shared_folder(spark, tmp_path):
    df = cut_lineage(spark.range(10))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


# --- address behaviour ------------------------------------------------------


def behaviour_rows(rng, address, n, step):
    at, out = T0, []
    for _ in range(n):
        at += rng.choice([0, 1, step, 3_600_000, 3_600_001, 86_400_000 - 1])
        out.append(("base", address, at, Decimal(rng.randint(0, 900)) / 8, rng.choice(["t1", "t2", None]), rng.choice(["p", None])))
    return out


def test_behaviour_slides_exactly(spark):
    rng = random.Random(11)
    rows = [r for a in ("0x1", "0x2") for r in behaviour_rows(rng, a, 300, 700)]
    rows += [("base", "0x1", T0 + 30 * 86_400_000 + x, Decimal(5), "t9", None) for x in (0, WEEK_MS - 1, WEEK_MS, 3 * WEEK_MS)]
    df = spark.createDataFrame(rows, "chain string, address string, at bigint, usd decimal(38,8), token string, protocol string")
    got = behaviour.behaviour_features(df.repartition(5), "2024-01-30").collect()
    assert len(got) == len({(r[1], r[2]) for r in rows})
    for r in got:
        end = round(r.window_end.replace(tzinfo=timezone.utc).timestamp() * 1000)
        own = [x for x in rows if x[1] == r.address and x[2] <= end]
        for span, ms in behaviour.SPANS.items():
            inside = [x for x in own if x[2] > end - ms]
            assert r[f"tx_count_{span}"] == len(inside)
            assert r[f"volume_usd_{span}"] == float(sum(x[3] for x in inside))
        assert r.max_tx_size_usd == float(max(x[3] for x in inside))
        assert r.unique_tokens_7d == len({x[4] for x in inside} - {None})
        assert r.unique_protocols_7d == len({x[5] for x in inside} - {None})
        assert r.activity_hours == sorted({x[2] // 3_600_000 % 24 for x in inside})


def test_busy_address_is_dealt_by_hour(spark):
    """One address with all rows: its windows lie in more than one task."""
    at = F.lit(T0) + F.col("id") * 60_000
    df = spark.range(20_000).select(F.lit("base").alias("chain"), F.lit("0xhot").alias("address"), at.alias("at"), F.lit(1).cast("decimal(38,8)").alias("usd"), F.lit("t").alias("token"), F.lit(None).cast("string").alias("protocol"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = timeline.running(df.withColumn("n", F.lit(1)), ["chain", "address"], "at", ["n"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r.n for r in rows) == list(range(1, 20_001))
    shares = Counter(r.task for r in rows)
    assert len(shares) > 1 and max(shares.values()) < 10_000


def test_time_in_risk_adds_up(spark):
    rng = random.Random(12)
    rows = [("0x1", "p", b, rng.uniform(0.5, 2.5), T0 + rng.randint(0, 10 * 86_400_000)) for b in range(200)]
    df = positions(spark, rows)
    got = behaviour.time_in_risk(df, "2023-12-01").collect()
    levels = [c for c in got[0].asDict() if c.endswith("_seconds") and c not in ("covered_seconds", "time_in_risk_seconds")]
    for r in got:
        assert sum(r[c] for c in levels) == pytest.approx(r.covered_seconds)
        assert r.time_in_risk_seconds == pytest.approx(r.covered_seconds - r.safe_seconds)
    first = min(r[4] for r in rows)
    assert sum(r.covered_seconds for r in got) == pytest.approx(datetime(2023, 12, 1, tzinfo=timezone.utc).timestamp() - first / 1000)
    assert max(r.covered_seconds for r in got) == 86_400


# --- policies and watch rules --------------------------------------------------


def test_policies_cross_each_threshold_once(spark, monkeypatch):
    rng = random.Random(13)
    configs = [(f"p{i}", json.dumps({"metric": rng.choice("mn"), "operator": rng.choice(["<", "<=", ">", ">="]), "threshold": rng.randint(0, 40) / 4}), None) for i in range(90)]
    odd = [("broken", "{", True), ("none", None, True), ("off", configs[0][1], False), ("blank", '{"metric":"m","operator":"<"}', True), ("other", '{"metric":"m","operator":"!=","threshold":1}', True)]
    seen = [(rng.choice("mn"), "base", f"0x{i % 5}", T0 + i, rng.choice([None, float("nan"), rng.randint(0, 40) / 4]), str(i)) for i in range(300)]
    observed = spark.createDataFrame(seen, "metric string, chain string, address string, at bigint, value double, ref string")
    parsed = policies.parse_policies(spark.createDataFrame(configs + odd, "name string, config string, enabled boolean"))
    got = Counter((r.policy, r.ref) for r in policies.crossings(observed, parsed).collect())
    compare = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
    want = Counter()
    for name, text, _ in configs:
        c = json.loads(text)
        want.update((name, s[5]) for s in seen if s[0] == c["metric"] and s[4] is not None and s[4] == s[4] and compare[c["operator"]](s[4], c["threshold"]))
    assert got == want
    assert policies.crossings(observed, parsed.limit(0)).count() == 0


def test_policy_cooldown_moves_on_alerts_only(spark):
    policy = spark.createDataFrame([("p", '{"metric":"m","operator":">","threshold":0,"cooldown_minutes":1}', True)], "name string, config string, enabled boolean")
    seen = [("m", "base", a, T0 + s * 1000, 1.0, f"{a}{s}") for a in ("x", "y") for s in (0, 30, 59, 60, 119, 121)]
    got = policies.policy_alerts(spark.createDataFrame(seen, "metric string, chain string, address string, at bigint, value double, ref string"), policy)
    assert sorted(r.ref for r in got.collect()) == ["x0", "x121", "x60", "y0", "y121", "y60"]


def test_watch_rules_with_odd_configs(spark):
    configs = [
        (1, "u", "address_watch", '{"addresses":["0xA",null],"min_severity":"HIGH"}', None),
        (2, "u", "address_watch", '{"addresses":["0xa","0xA"]}', True),
        (3, "u", "address_watch", '{"addresses":[]}', True),
        (4, "u", "risk_threshold", '{"risk_levels":["danger"]}', True),
        (5, "u", "whale_alert", '{"min_amount_usd":10}', True),
        (6, "u", "whale_alert", '{"tokens":["usdc"]}', True),
        (7, "u", "whale_alert", "{broken", True),
        (8, "u", "whale_alert", None, True),
        (9, "u", "unheard_of", '{"min_amount_usd":0}', True),
        (10, "u", "address_watch", '{"addresses":["0xa"],"min_severity":"LOUD"}', True),
        (11, "u", "address_watch", '{"addresses":["0xa"]}', False),
    ]
    index = policies.watch_index(
        spark.createDataFrame(configs, "id int, user_id string, config_type string, config_value string, enabled boolean"),
        spark.createDataFrame([(1, "v", "0xA", None, None, None), (2, "v", "0xb", False, True, Decimal("9"))], "id int, user_id string, address string, alert_on_risk boolean, alert_on_activity boolean, risk_threshold decimal(5,2)"),
    )
    alerts = spark.createDataFrame([("a1", "0xa", "HIGH", "DANGER", Decimal(5)), ("a2", "0xa", "INFO", "SAFE", Decimal(5))], "alert_id string, user_address string, severity string, current_risk_level string, total_collateral_usd decimal(38,8)")
    held = spark.createDataFrame([("p", "0xa", 1, 1.1), ("p", "0xa", 2, 1.2)], "protocol string, user_address string, block_number bigint, health_factor double")
    moved = spark.createDataFrame([("t", 1, "USDC", "0xa", "0xb", 10.0), ("t", 2, None, "0xc", "0xc", None)], "tx_hash string, log_index int, token_symbol string, from_address string, to_address string, amount_usd double")
    got = sorted((r.rule, r.event) for r in policies.watch_matches(policies.watch_events(alerts, held, moved), index).collect())
    assert got == [("c1", "a1"), ("c2", "a1"), ("c2", "a2"), ("c4", "a1"), ("c5", "t-1"), ("c6", "t-1"), ("w1", "p-0xa-1"), ("w2", "t-1")]
