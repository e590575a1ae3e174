"""Aggregates that are shuffled once, by their plans; what they return is compared elsewhere."""

from tidemark.operators import behaviour, timeline, whales


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_hourly_flow_of_addresses_is_shuffled_once_and_sorted_once(spark):
    staged = spark.range(400).selectExpr(
        "'base' chain", "timestamp_seconds(id * 100) event_timestamp", "concat('t', id % 3) token_address", "if(id % 9 = 0, null, id * 1D) amount_usd",
        "concat('a', id % 7) from_address", "concat('b', id % 5) to_address",
    )
    flow = behaviour.address_flow_hourly(staged, "2024-01-30")
    plan = flow._jdf.queryExecution().executedPlan().toString()
    assert exchanges(flow) == 1
    assert plan.count("Sort [") == 1 and "HashAggregate" not in plan.replace("SortAggregate", "")
    tops = {(r.address, r.hour): r for r in flow.collect()}
    assert len(tops) == len({(r.address, r.hour) for r in flow.select("address", "hour").collect()})
    assert sum(r.outflow_count for r in tops.values()) == 400 == sum(r.inflow_count for r in tops.values())


def test_large_transfers_go_to_their_senders_once(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        staged = spark.range(300).selectExpr(
            "concat('m', id) transfer_id", "timestamp_seconds(id) event_timestamp", "date '2024-01-01' event_date", "'t' token_address", "'T' token_symbol",
            "if(id % 10 = 0, null, concat('a', id % 10)) from_address", "if(id % 7 = 0, null, concat('a', id % 7)) to_address", "1D amount", "1e9 amount_usd",
            "concat('h', id) tx_hash", "id block_number",
        )
        listed = spark.createDataFrame([("a1",), ("a2",), ("",), (None,)], "address string")
        moved = whales.whale_movements(staged, listed, "2024-01-30")
        plan = moved._jdf.queryExecution().executedPlan().toString().split("\n")
        assert any("ReusedExchange" in line and "transfer_id" in line for line in plan)
        want = {f"m{i}": "whale_out" if i % 10 in (1, 2) else "whale_in" for i in range(300) if i % 10 in (1, 2) or i % 7 in (1, 2)}
        got = moved.collect()
        assert len(got) == len(want) and {r.movement_id: r.whale_direction for r in got} == want
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_look_back_reads_rows_and_summary_from_one_shuffle(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(500).selectExpr("if(id % 50 = 0, null, id % 9) k", "if(id = 7, null, id * 40000000 % 900000000) at", "id n", "if(id % 4 = 0, null, 60000000) gap")
        kept = timeline.keep_spaced(rows, ["k"], "at", "gap", ["n"])
        assert "ReusedExchange" in kept._jdf.queryExecution().executedPlan().toString()
        last, want = {}, set()
        for r in sorted((r for r in rows.collect() if r["at"] is not None), key=lambda r: (r["at"], r["n"])):
            if r["k"] not in last or r["at"] - last[r["k"]] >= (r["gap"] or 0):
                last[r["k"]] = r["at"]
                want.add((r["k"], r["at"], r["n"]))
        assert sorted(map(tuple, kept.drop("gap").collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
