"""The scheduled runs: staging, core and mart models in dependency order with their checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame

from tidemark.config import DEFAULTS, RISK_LEVELS, Settings
from tidemark.functions.values import day_of
from tidemark.operators import checks, flows, lending, positions, staging, whales
from tidemark.plans import marts
from tidemark.plans.materialize import TableSpec, Warehouse, store_failures

SPECS = {
    spec.name: spec
    for spec in (
        TableSpec("stg_base_blocks", "view"),
        TableSpec("stg_base_aave_events", "view"),
        TableSpec("stg_base_positions", "view"),
        TableSpec("stg_base_transfers", "view"),
        TableSpec("stg_market_prices", "view"),
        TableSpec(
            "core_address_positions", "delete_insert", "position_key", "block_number",
            high_water="block_number", order_by=("block_number",),
        ),
        TableSpec(
            "core_address_netflow_daily", "delete_insert", "netflow_key", partition_by="event_date",
            high_water="event_date", order_by=("address",), dealt=True,
        ),
        TableSpec(
            "core_cdp_metrics_daily", "delete_insert", "metrics_key", partition_by="metrics_date",
            high_water="metrics_date", order_by=("protocol",), small_days=True,
        ),
        TableSpec(
            "core_token_metrics_daily", "delete_insert", "metrics_key", partition_by="metrics_date",
            high_water="metrics_date", order_by=("token_address",), small_days=True,
        ),
        TableSpec("core_whale_addresses", "table"),
        TableSpec("mart_risk_dashboard", "table"),
        TableSpec(
            "mart_whale_movements", "append", "movement_id", partition_by="event_date",
            high_water="event_timestamp", order_by=("event_timestamp",), dealt=True,
        ),
        TableSpec("mart_ecosystem_kpis", "table"),
        TableSpec("mart_protocol_summary", "table"),
    )
}

LAYERS = {
    "staging": tuple(n for n in SPECS if n.startswith("stg_")),
    "core": tuple(n for n in SPECS if n.startswith("core_")),
    "mart": tuple(n for n in SPECS if n.startswith("mart_")),
}

# The models of the hourly run; the daily run takes all of them.
HOURLY = (
    *LAYERS["staging"],
    "core_address_positions",
    "core_address_netflow_daily",
    "mart_whale_movements",
    "mart_ecosystem_kpis",
)


@dataclass(frozen=True)
class Inputs:
    """The raw tables, in their canonical schemas."""

    blocks: DataFrame
    lending_events: DataFrame
    positions: DataFrame
    transfers: DataFrame
    prices: DataFrame
    rt_risk: DataFrame


@dataclass
class Run:
    """One run. Without a range, incremental models start at their high-water
    mark; with `start` and `end` (inclusive days) exactly those days are rebuilt."""

    inputs: Inputs
    warehouse: Warehouse
    as_of: str | datetime
    settings: Settings = DEFAULTS
    full_refresh: bool = False
    start: date | None = None
    end: date | None = None
    failures: dict[str, int] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.warehouse.read(SPECS[name])

    def since(self, name: str):
        """First day an incremental daily model has to read."""
        if self.start is not None:
            return self.start
        if self.full_refresh:
            return None
        spec = SPECS[name]
        if not self.warehouse.exists(spec):
            return None
        return self.warehouse.mark(spec, day_of(self.settings.default_start_date))

    def until(self) -> datetime | None:
        return None if self.end is None else datetime.combine(self.end + timedelta(days=1), time())

    def staged(self, builder: Callable, raw: DataFrame, since=None) -> DataFrame:
        start = datetime.combine(since, time()) if type(since) is date else since
        return builder(raw, start=start, end=self.until())


def _address_positions(run: Run) -> DataFrame:
    raw = staging.bounded(run.inputs.positions, run.start and run.start.isoformat(), run.until())
    above = None
    if run.start is None and not run.full_refresh:
        above = run.warehouse.mark(SPECS["core_address_positions"])
    return positions.address_positions(raw, run.inputs.rt_risk, run.as_of, run.settings, above_block=above)


def _netflow(run: Run) -> DataFrame:
    since = run.since("core_address_netflow_daily")
    return flows.address_netflow_daily(
        run.staged(staging.stg_transfers, run.inputs.transfers, since), run.as_of, run.settings
    )


def _cdp(run: Run) -> DataFrame:
    since = run.since("core_cdp_metrics_daily")
    return lending.cdp_metrics_daily(
        run.staged(staging.stg_lending_events, run.inputs.lending_events, since),
        run.staged(staging.stg_positions, run.inputs.positions, since),
        run.as_of,
        settings=run.settings,
    )


def _tokens(run: Run) -> DataFrame:
    since = run.since("core_token_metrics_daily")
    return flows.token_metrics_daily(
        run.staged(staging.stg_transfers, run.inputs.transfers, since),
        run.staged(staging.stg_prices, run.inputs.prices, since),
        run.as_of,
        run.settings,
    )


def _whales(run: Run) -> DataFrame:
    recent = day_of(run.as_of) - timedelta(days=run.settings.whale_window_days)
    transfers = staging.stg_transfers(run.inputs.transfers, start=recent.isoformat())
    return whales.whale_addresses(run.table("core_address_positions"), transfers, run.as_of, run.settings)


def _movements(run: Run) -> DataFrame:
    spec = SPECS["mart_whale_movements"]
    mark = None
    if run.start is None and not run.full_refresh and run.warehouse.exists(spec):
        mark = run.warehouse.mark(spec)
    # The mark prunes the raw scan; the strict comparison follows on the staged time.
    transfers = run.staged(staging.stg_transfers, run.inputs.transfers, run.start or mark)
    return whales.whale_movements(
        transfers, run.table("core_whale_addresses"), run.as_of, run.settings, after=mark
    )


def _kpis(run: Run) -> DataFrame:
    today = staging.stg_transfers(run.inputs.transfers, start=day_of(run.as_of).isoformat())
    return marts.ecosystem_kpis(run.table("core_address_positions"), today, run.as_of)


def _summary(run: Run) -> DataFrame:
    month = day_of(run.as_of) - timedelta(days=30)
    events = staging.stg_lending_events(run.inputs.lending_events, start=month.isoformat())
    return marts.protocol_summary(run.table("core_address_positions"), events, run.as_of, run.settings)


BUILDERS: dict[str, Callable[[Run], DataFrame]] = {
    "stg_base_blocks": lambda run: staging.stg_blocks(run.inputs.blocks),
    "stg_base_aave_events": lambda run: staging.stg_lending_events(run.inputs.lending_events),
    "stg_base_positions": lambda run: staging.stg_positions(run.inputs.positions),
    "stg_base_transfers": lambda run: staging.stg_transfers(run.inputs.transfers),
    "stg_market_prices": lambda run: staging.stg_prices(run.inputs.prices),
    "core_address_positions": _address_positions,
    "core_address_netflow_daily": _netflow,
    "core_cdp_metrics_daily": _cdp,
    "core_token_metrics_daily": _tokens,
    "core_whale_addresses": _whales,
    "mart_risk_dashboard": lambda run: marts.risk_dashboard(run.table("core_address_positions"), run.as_of),
    "mart_whale_movements": _movements,
    "mart_ecosystem_kpis": _kpis,
    "mart_protocol_summary": _summary,
}

Check = Callable[[DataFrame], DataFrame]


def _key(column: str) -> dict[str, Check]:
    return {
        f"unique_{column}": lambda df: checks.unique(df, column),
        f"not_null_{column}": lambda df: checks.not_null(df, column),
    }


CHECKS: dict[str, dict[str, Check]] = {
    "stg_base_blocks": _key("block_number"),
    "stg_base_aave_events": {
        "accepted_values_event_type": lambda df: checks.accepted_values(df, "event_type", list(lending.PIVOTED_EVENTS)),
        "not_null_user_address": lambda df: checks.not_null(df, "user_address"),
    },
    "core_address_positions": {
        **_key("position_key"),
        "not_null_health_factor": lambda df: checks.not_null(df, "health_factor"),
        "accepted_range_health_factor": lambda df: checks.accepted_range(df, "health_factor", 0, 1000),
        "accepted_values_risk_level": lambda df: checks.accepted_values(df, "risk_level", list(RISK_LEVELS)),
    },
    "core_address_netflow_daily": {
        "unique_combination": lambda df: checks.unique_combination(df, ["event_date", "address", "token_address"])
    },
    "core_cdp_metrics_daily": _key("metrics_key"),
    "core_token_metrics_daily": _key("metrics_key"),
    "core_whale_addresses": _key("address"),
    "mart_whale_movements": _key("movement_id"),
    "mart_protocol_summary": _key("protocol"),
}


def check_model(run: Run, name: str) -> None:
    """Run a model's checks; failing rows are stored and counted, never raised (severity: warn)."""
    rules = CHECKS.get(name, {})
    # One reader for all checks: the folders of a daily table are listed once.
    rows = run.table(name) if rules else None
    for check, rule in rules.items():
        path = run.warehouse.path(f"test_failures/{name}/{check}")
        store_failures(rule(rows), path)
        count = run.warehouse.spark.read.parquet(path).count()
        if count:
            run.failures[f"{name}.{check}"] = count


def build(run: Run, name: str) -> None:
    run.warehouse.materialize(
        BUILDERS[name](run),
        SPECS[name],
        full_refresh=run.full_refresh and run.start is None,
        replace_partitions=run.start is not None,
    )


def run_models(run: Run, names: tuple[str, ...], test: bool = True) -> Run:
    """Build models layer by layer, testing each layer before the next."""
    for layer in LAYERS.values():
        chosen = [n for n in layer if n in names]
        for name in chosen:
            build(run, name)
        if test:
            for name in chosen:
                check_model(run, name)
    return run


def run_daily(run: Run) -> Run:
    return run_models(run, tuple(SPECS))


def run_hourly(run: Run) -> Run:
    """The frequent subset; like the schedule it mirrors, it runs without tests."""
    return run_models(run, HOURLY, test=False)


def run_backfill(run: Run, models: str = "core") -> Run:
    """A layer or a single model, over the run's range or as a full refresh."""
    return run_models(run, LAYERS.get(models, (models,)))
