"""Netflow is shuffled once, from the legs of transfers to the files of a day."""

from pyspark.sql import functions as F

from tidemark.operators import flows
from tidemark.plans.materialize import Warehouse
from tidemark.plans.pipeline import SPECS


def test_netflow_is_shuffled_once_and_its_days_have_few_files(spark, tmp_path):
    spec = SPECS["core_address_netflow_daily"]
    staged = spark.range(20_000).selectExpr(
        "date_add(date '2024-01-01', int(id % 5)) event_date", "'t' token_address", "if(id % 11 = 0, 'B', 'A') token_symbol", "1D amount", "2D amount_usd",
        "'transfer' transfer_type", "concat('f', id % 300) from_address", "concat('g', id % 70) to_address",
    )
    netflow = flows.address_netflow_daily(staged, "2024-01-30")
    executed = netflow._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1
    house, copy = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    house.materialize(netflow, spec, full_refresh=True)
    house.retain(spec, "event_date", 100, "2024-01-30", copy)
    files = copy.read(spec).groupBy("event_date").agg(F.count_distinct("_metadata.file_path").alias("n")).agg(F.max("n")).first()[0]
    assert files <= flows.DAY_PARTS and copy.read(spec).count() == netflow.count()
