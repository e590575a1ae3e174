"""Address behaviour in one pass: parts, chunks and windows that meet at their edges, and what the pass shuffles."""

import random
from decimal import Decimal, localcontext

import pyarrow as pa

from tidemark.operators import behaviour, sliding
from tidemark.operators.behaviour import PART_MS, SPANS, WEEK_MS

SCHEMA = "chain string, address string, at bigint, usd decimal(38,8), token string, protocol string"


def rows_of(rng, n):
    edges = [k * PART_MS + d for k in (703, 704) for d in (-WEEK_MS - 1, -WEEK_MS, -WEEK_MS + 1, -1, 0, 1, WEEK_MS - 1, WEEK_MS)]
    moments = edges + [703 * PART_MS + rng.randint(-WEEK_MS, 2 * PART_MS) for _ in range(60)]
    large = [Decimal(10) ** 27 - 1, Decimal(-5), None, Decimal("0.00000001"), Decimal("92233720368.54775808")]
    value = lambda: rng.choice(large) if rng.random() < 0.3 else Decimal(rng.randint(0, 900)) / 8
    return [("base", rng.choice(["0x1", "0x2"]), rng.choice(moments), value(), rng.choice(["t1", "t2", None]), rng.choice(["p", None])) for _ in range(n)]


def by_hand(rows):
    with localcontext(prec=60):
        return _by_hand(rows)


def _by_hand(rows):
    out = {}
    for chain, address, at, *_ in rows:
        inside = {s: [x for x in rows if x[:2] == (chain, address) and at - ms < x[2] <= at] for s, ms in SPANS.items()}
        week = inside["7d"]
        usd = lambda own: sum((x[3] or Decimal(0) for x in own), Decimal(0))
        out[chain, address, at] = (
            *(f for s in SPANS for f in (len(inside[s]), usd(inside[s]))), len({x[4] for x in week} - {None}), len({x[5] for x in week} - {None}),
            sum({1 << x[2] // 3_600_000 % 24 for x in week}), max(x[3] or Decimal(0) for x in week),
        )
    return out


def test_chunks_meet(monkeypatch):
    """Batches and chunks of a few rows, several in one moment, sums beyond 64 bits, amounts below 0."""
    rows = rows_of(random.Random(31), 600)
    ordered = sorted([(r[0], r[1], 7, r[2], r[3] or Decimal(0), r[4], r[5], r[2] % 5 > 0) for r in rows], key=lambda r: r[:4])
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.decimal128(38, 8), pa.string(), pa.string(), pa.bool_()]
    names = ["chain", "address", "part", "at", "usd", "token", "protocol", "own"]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*ordered), kinds)], names=names)
    want = {k: v for k, v in by_hand(rows).items() if k[2] % 5 > 0}
    for size, chunk in ((3, 5), (1, 1), (40, 64), (600, 1000)):
        monkeypatch.setattr(sliding, "CHUNK", chunk)
        got = {}
        for batch in sliding.slide(iter(table.to_batches(max_chunksize=size)), ["chain", "address"], SPANS):
            for r in batch.to_pylist():
                values = tuple(r.values())
                assert values[:3] not in got
                got[values[:3]] = values[3:]
        assert got == want and len(want) > 80


def test_parts_meet(spark):
    """Moments at the edges of the parts that an address is dealt by."""
    rows = rows_of(random.Random(32), 400)
    want = by_hand(rows)
    got = behaviour.behaviour_features(spark.createDataFrame(rows, SCHEMA).repartition(3), "2024-01-30").selectExpr("*", "unix_millis(window_end) at").collect()
    assert len(got) == len(want)
    for r in got:
        n1, v1, n24, v24, n7, v7, tokens, protocols, hours, most = want[r.chain, r.address, r["at"]]
        assert (r.tx_count_1h, r.tx_count_24h, r.tx_count_7d, r.unique_tokens_7d, r.unique_protocols_7d) == (n1, n24, n7, tokens, protocols)
        assert (r.volume_usd_1h, r.volume_usd_24h, r.volume_usd_7d, r.max_tx_size_usd) == tuple(map(float, (v1, v24, v7, most)))
        assert sum(1 << h for h in r.activity_hours) == hours


def test_behaviour_shuffles_its_rows_once(spark):
    """One shuffle, of the rows and of those that lead in to the next four weeks."""
    rows = spark.range(8_000).selectExpr(
        "'base' chain", "concat('0x', id % 40) address", "1700000000000 + id div 40 * 10800000 at", "cast(id % 7 as decimal(38,8)) usd", "'t' token", "'p' protocol"
    )
    features = behaviour.behaviour_features(rows, "2024-01-30")
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def written():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = written()
    assert len(features.collect()) == 8_000
    assert written() - before < 12_000
