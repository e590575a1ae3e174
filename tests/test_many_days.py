"""Daily tables of many days with few rows: the folders are written by all tasks, and listed once for all checks of a model."""

from pyspark.sql import functions as F

from tidemark.plans import pipeline
from tidemark.plans.materialize import Warehouse
from tidemark.plans.pipeline import SPECS


def _days(spark):
    return spark.range(600).selectExpr("date_add(date '2000-01-01', int(id % 300)) metrics_date", "concat('p', id % 2) protocol", "concat('k', id) metrics_key", "id")


def test_many_small_days_are_written_by_all_tasks(spark, tmp_path):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, order in (("core_cdp_metrics_daily", "protocol"), ("core_token_metrics_daily", "token_address")):
        house, spec = Warehouse(spark, str(tmp_path / name)), SPECS[name]
        house.materialize(_days(spark).withColumnRenamed("protocol", order), spec, full_refresh=True)
        rows = house.read(spec)
        files = rows.select("metrics_date", F.col("_metadata.file_path").alias("path"))
        writers = files.select(F.regexp_extract("path", r"part-(\d+)-", 1)).distinct().count()
        assert writers == tasks
        assert files.distinct().count() == 300 and rows.agg(F.count("id"), F.sum("id")).first() == (600, 600 * 599 // 2)


def test_a_later_run_replaces_only_its_small_days(spark, tmp_path):
    house, spec = Warehouse(spark, str(tmp_path)), SPECS["core_cdp_metrics_daily"]
    house.materialize(_days(spark), spec, full_refresh=True)
    house.materialize(_days(spark).where("id % 300 < 3").withColumn("id", F.col("id") + 1000), spec)
    assert house.read(spec).agg(F.count("id"), F.count_if(F.col("id") >= 1000)).first() == (600, 6)


def test_a_model_is_read_once_for_all_its_checks(spark, tmp_path, monkeypatch):
    house, name, reads = Warehouse(spark, str(tmp_path)), "core_cdp_metrics_daily", []
    house.materialize(_days(spark).withColumn("metrics_key", F.when(F.col("id") < 2, "twice").when(F.col("id") > 2, F.col("metrics_key"))), SPECS[name], full_refresh=True)
    run, table = pipeline.Run(None, house, "2024-01-30"), pipeline.Run.table
    monkeypatch.setattr(pipeline.Run, "table", lambda self, n: reads.append(n) or table(self, n))
    pipeline.check_model(run, name)
    assert reads == [name]
    assert run.failures == {f"{name}.unique_metrics_key": 1, f"{name}.not_null_metrics_key": 1}
