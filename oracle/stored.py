"""Registered queries that go through storage: readers, incremental tables, backfill, retention.

Every query writes to a new folder below the shared one and returns what is read back.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import registry
from oracle.registry import ENTRIES, FLOW_SUMS, register
from oracle.views import AS_OF, TODAY, raw, rt_risk
from tidemark.plans import pipeline
from tidemark.plans.materialize import Warehouse
from tidemark.plans.pipeline import SPECS, Inputs, Run
from tidemark.session import checkpoint_root, use_utc
from tidemark.sources import raw as raw_tables

HALF_MS = 1_703_000_000_000
HALF_DAY = "2023-12-19 12:00:00"
SPAN = {"start": date(2023, 12, 1), "end": date(2023, 12, 3)}


def folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(use_utc(spark))}/stored-{uuid.uuid4().hex}"


# --- readers ------------------------------------------------------------------


def _reread(name: str, reader, columns: str, file_format: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        path = folder(s)
        raw(s, d, name).write.format(file_format).save(path)
        return reader(s, path, file_format).select(*columns.replace(" ", "").split(","))

    return run


for _name, _reader, _columns, _format in (
    ("raw_blocks", raw_tables.raw_blocks, registry._B, "parquet"),
    ("raw_lending_events", raw_tables.raw_lending_events, registry._E, "json"),
    ("raw_transfers", raw_tables.raw_transfers, registry._T, "parquet"),
    ("raw_positions", raw_tables.raw_positions, registry._P, "parquet"),
    ("raw_prices", raw_tables.raw_prices, registry._M, "json"),
):
    register(f"read_{_name}", _reread(_name, _reader, _columns, _format), ENTRIES[f"source_{_name[4:]}"].body)


# --- incremental tables ---------------------------------------------------------


def _inputs(s: SparkSession, d: str, before: int | None = None) -> Inputs:
    names = ("raw_blocks", "raw_lending_events", "raw_positions", "raw_transfers", "raw_prices")
    frames = [raw(s, d, n) for n in names]
    if before is not None:
        frames = [f.where(F.col("timestamp") < before) for f in frames]
    return Inputs(*frames, rt_risk(s, d, "block_number % 3 = 0"))


def _table(house: Warehouse, name: str) -> DataFrame:
    return house.read(SPECS[name]).drop("dbt_updated_at")


def _in_two_steps(name: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        house = Warehouse(s, folder(s))
        pipeline.run_models(Run(_inputs(s, d, HALF_MS), house, HALF_DAY), (name,), test=False)
        pipeline.run_models(Run(_inputs(s, d), house, AS_OF), (name,), test=False)
        return _table(house, name)

    return run


register("two_step_netflow", _in_two_steps("core_address_netflow_daily"), "select * exclude (dbt_updated_at) from netflow", FLOW_SUMS)
register("two_step_positions", _in_two_steps("core_address_positions"), "select * exclude (dbt_updated_at) from core_positions")


def _appended(s: SparkSession, d: str) -> DataFrame:
    """Movements appended beyond the mark: a second run over the same input adds none."""
    house = Warehouse(s, folder(s))
    names = ("core_address_positions", "core_whale_addresses", "mart_whale_movements")
    pipeline.run_models(Run(_inputs(s, d), house, AS_OF, full_refresh=True), names, test=False)
    pipeline.run_models(Run(_inputs(s, d), house, AS_OF), ("mart_whale_movements",), test=False)
    return _table(house, "mart_whale_movements")


register("appended_movements", _appended, "select * exclude (dbt_updated_at) from movements")


def _backfilled(s: SparkSession, d: str) -> DataFrame:
    """A table built from broken amounts, three days of it rebuilt from the right ones."""
    house, name = Warehouse(s, folder(s)), "core_address_netflow_daily"
    broken = Inputs(**{**_inputs(s, d).__dict__, "transfers": raw(s, d, "raw_transfers").withColumn("amount_usd", F.lit(1.0))})
    pipeline.run_models(Run(broken, house, AS_OF, full_refresh=True), (name,), test=False)
    pipeline.run_backfill(Run(_inputs(s, d), house, AS_OF, **SPAN), name)
    return _table(house, name).withColumn("rebuilt", F.col("event_date").between(F.lit(SPAN["start"]), F.lit(SPAN["end"]))).where("rebuilt").drop("rebuilt")


register(
    "backfilled_netflow",
    _backfilled,
    f"select * exclude (dbt_updated_at) from netflow where event_date between date '{SPAN['start']}' and date '{SPAN['end']}'",
    FLOW_SUMS,
)


def _corrected(s: SparkSession, d: str) -> DataFrame:
    """A key log whose rows are appended again with the same blocks: the later build wins."""
    house, name = Warehouse(s, folder(s)), "core_address_positions"
    inputs = _inputs(s, d)
    broken = Inputs(**{**inputs.__dict__, "positions": inputs.positions.withColumn("health_factor", F.lit(9.0))})
    pipeline.run_models(Run(broken, house, HALF_DAY, full_refresh=True), (name,), test=False)
    house.materialize(pipeline.BUILDERS[name](Run(inputs, house, AS_OF, full_refresh=True)), SPECS[name])
    return _table(house, name)


register("corrected_positions", _corrected, "select * exclude (dbt_updated_at) from core_positions")


def _retained(s: SparkSession, d: str) -> DataFrame:
    house, name = Warehouse(s, folder(s)), "core_address_netflow_daily"
    pipeline.run_models(Run(_inputs(s, d), house, AS_OF, full_refresh=True), (name,), test=False)
    kept = Warehouse(s, folder(s))
    house.retain(SPECS[name], "event_date", 30, AS_OF, kept)
    return _table(kept, name)


register("retained_netflow", _retained, f"select * exclude (dbt_updated_at) from netflow where event_date >= {TODAY} - 30", FLOW_SUMS)


def _dropped(s: SparkSession, d: str) -> DataFrame:
    """Old days dropped as folders: each kept day with its rows, and whether it still lies in the files it was written to."""
    house, spec = Warehouse(s, folder(s)), SPECS["core_address_netflow_daily"]
    pipeline.run_models(Run(_inputs(s, d), house, AS_OF, full_refresh=True), (spec.name,), test=False)
    files = lambda: house.read(spec).groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"), F.array_sort(F.collect_set(F.concat_ws(":", "_metadata.file_path", "_metadata.file_modification_time"))).alias("files"))
    earlier = folder(s)
    files().write.parquet(earlier)
    gone = house.drop_days(spec, 30, AS_OF)
    after = files().join(s.read.parquet(earlier).select("event_date", F.col("files").alias("earlier")), "event_date")
    return after.select("event_date", "row_count", (F.col("files") == F.col("earlier")).alias("untouched"), F.lit(len(gone)).cast("long").alias("dropped_days"))


register(
    "dropped_days_netflow",
    _dropped,
    f"""select event_date, count(*) row_count, true untouched, (select count(distinct event_date) from netflow where event_date < {TODAY} - 30) dropped_days
     from netflow where event_date >= {TODAY} - 30 group by event_date""",
)


def _backfilled_all(s: SparkSession, d: str) -> DataFrame:
    """The whole table after a backfill of three days: the other days keep the amounts they were first built from."""
    house, name = Warehouse(s, folder(s)), "core_address_netflow_daily"
    broken = Inputs(**{**_inputs(s, d).__dict__, "transfers": raw(s, d, "raw_transfers").withColumn("amount_usd", F.lit(1.0))})
    pipeline.run_models(Run(broken, house, AS_OF, full_refresh=True), (name,), test=False)
    pipeline.run_backfill(Run(_inputs(s, d), house, AS_OF, **SPAN), name)
    return _table(house, name)


_INSIDE = f"event_date between date '{SPAN['start']}' and date '{SPAN['end']}'"
register(
    "backfilled_netflow_all_days",
    _backfilled_all,
    f"""select * exclude (dbt_updated_at) replace (case when {_INSIDE} then inflow_usd else inflow_count end as inflow_usd,
     case when {_INSIDE} then outflow_usd else outflow_count end as outflow_usd, case when {_INSIDE} then net_usd else cast(inflow_count as double) - outflow_count end as net_usd) from netflow""",
    FLOW_SUMS,
)


def _appended_new(s: SparkSession, d: str) -> DataFrame:
    """Movements of the first half, then those beyond the mark: the second run appends the rest and repeats none."""
    house = Warehouse(s, folder(s))
    whole, half = _inputs(s, d), _inputs(s, d, HALF_MS)
    pipeline.run_models(Run(whole, house, AS_OF, full_refresh=True), ("core_address_positions", "core_whale_addresses"), test=False)
    pipeline.run_models(Run(half, house, HALF_DAY), ("mart_whale_movements",), test=False)
    pipeline.run_models(Run(whole, house, AS_OF), ("mart_whale_movements",), test=False)
    return _table(house, "mart_whale_movements").withColumn("second_run", F.col("event_timestamp") >= F.timestamp_millis(F.lit(HALF_MS)))


register(
    "appended_new_movements",
    _appended_new,
    f"select * exclude (dbt_updated_at), event_timestamp >= make_timestamp({HALF_MS} * 1000) second_run from movements",
)


def _checked(s: SparkSession, d: str) -> DataFrame:
    """The daily run with its checks: every model is built, and each failing check is counted and its rows are kept."""
    house = Warehouse(s, folder(s))
    run = pipeline.run_daily(Run(_inputs(s, d), house, AS_OF, full_refresh=True))
    built = [(n, house.read(SPECS[n]).count(), sum(c for k, c in run.failures.items() if k.split(".")[0] == n)) for n in SPECS]
    return s.createDataFrame(built, "model string, row_count long, failures long")


_MODELS = {
    "stg_base_blocks": "stg_blocks", "stg_base_aave_events": "stg_lending_events", "stg_base_positions": "stg_positions", "stg_base_transfers": "stg_transfers",
    "stg_market_prices": "stg_prices", "core_address_positions": "core_positions", "core_address_netflow_daily": "netflow", "core_cdp_metrics_daily": "cdp_metrics",
    "core_token_metrics_daily": "token_metrics", "core_whale_addresses": "whales", "mart_whale_movements": "movements",
}
_KEYS = {"stg_blocks": "block_number", "core_positions": "position_key", "cdp_metrics": "metrics_key", "token_metrics": "metrics_key", "whales": "address", "movements": "movement_id", "protocol_summary": "protocol"}


def _failing(cte: str) -> str:
    if cte == "stg_lending_events":
        return "count(distinct event_type) filter (event_type not in ('supply', 'withdraw', 'borrow', 'repay', 'liquidation'))"
    key = _KEYS.get(cte)
    return f"(select count(*) from (select {key} from {cte} group by {key} having count(*) > 1))" if key else "cast(0 as bigint)"


register(
    "daily_run",
    _checked,
    " union all ".join(f"select '{model}' model, count(*) row_count, {_failing(cte)} failures from {cte}" for model, cte in {**_MODELS, "mart_protocol_summary": "protocol_summary"}.items())
    + f" union all select 'mart_risk_dashboard', count(*), 0 from ({ENTRIES['mart_risk_dashboard'].body}) union all select 'mart_ecosystem_kpis', 1, 0",
)
