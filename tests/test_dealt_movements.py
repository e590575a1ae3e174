"""Movements are shuffled for their senders and receivers only, and are written from there."""

from pyspark.sql import functions as F

from tidemark.operators import whales
from tidemark.plans.materialize import Warehouse
from tidemark.plans.pipeline import SPECS

HASHES = ["0x" + "ab" * 32, "0x" + "AB" * 32, "0xabc", "0x", "", "abab", None]


def staged(spark, n):
    hashes = F.array(*[F.lit(h) for h in HASHES])
    return spark.range(n).selectExpr(
        "concat('m', id) transfer_id", "timestamp_seconds(1700000000 + id * 700) event_timestamp", "if(id = 3, null, date(timestamp_seconds(1700000000 + id * 700))) event_date", "'t' token_address", "'T' token_symbol",
        "if(id % 10 = 0, null, concat('a', id % 10)) from_address", "if(id % 7 = 0, null, concat('b', id % 7)) to_address", "1D amount", "if(id % 11 = 0, 1D, 1e9) amount_usd", "id block_number", "id",
    ).withColumn("tx_hash", F.get(hashes, (F.col("id") % len(HASHES)).cast("int"))).drop("id")


def test_movements_are_not_shuffled_again_for_their_days(spark, tmp_path):
    """Without broadcasts: senders' rows travel once, those of other senders twice, none a third time."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def shuffled():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    listed = spark.createDataFrame([(f"a{i}",) for i in range(1, 9)], "address string")
    house, spec = Warehouse(spark, str(tmp_path)), SPECS["mart_whale_movements"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        started = shuffled()
        house.materialize(whales.whale_movements(staged(spark, 20_000), listed, "2024-01-30"), spec, full_refresh=True)
        assert shuffled() - started < 20_000 + 4_000 + 1_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    files = house.read(spec).groupBy("event_date").agg(F.count_distinct("_metadata.file_path").alias("n")).agg(F.max("n")).first()[0]
    assert files <= 2 * whales.PARTS


def test_movements_of_all_directions_keep_their_hashes(spark):
    """Hashes that are no bytes, in capitals or missing come back as they were; a null party or day meets nobody else's list entry."""
    listed = spark.createDataFrame([("a1",), ("a1",), ("b2",), ("b3",), ("",), (None,)], "address string")
    rows = staged(spark, 700)
    got = {r.movement_id: (r.whale_direction, r.tx_hash) for r in whales.whale_movements(rows, listed, "2024-01-30").collect()}
    want = {}
    for r in rows.collect():
        if r.amount_usd >= 10_000 and (r.from_address == "a1" or r.to_address in ("b2", "b3")):
            want[r.transfer_id] = ("whale_out" if r.from_address == "a1" else "whale_in", r.tx_hash)
    assert got == want and len(got) > 200 and "m3" in got
