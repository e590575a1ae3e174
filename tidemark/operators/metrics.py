"""Metric registry: measures, dimensions and metrics compiled to one `groupBy().agg()`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import day_of


@dataclass(frozen=True)
class SemanticModel:
    time: str
    dimensions: tuple[str, ...]
    measures: dict[str, tuple[str, str]]  # name -> (aggregate, column)


@dataclass(frozen=True)
class Metric:
    model: str
    measure: str
    condition: Callable[[date], Column] | None = None


@dataclass(frozen=True)
class Ratio:
    """A derived metric: numerator over denominator, NULL where that is 0."""

    numerator: str
    denominator: str


MODELS = {
    "address_positions": SemanticModel(
        time="position_timestamp",
        dimensions=("position_key", "chain", "protocol", "user_address", "risk_level", "position_size_tier"),
        measures={
            "total_collateral_usd": ("sum", "total_collateral_usd"),
            "total_debt_usd": ("sum", "total_debt_usd"),
            "avg_health_factor": ("avg", "health_factor"),
            "min_health_factor": ("min", "health_factor"),
            "position_count": ("count", "position_key"),
            "unique_users": ("count_distinct", "user_address"),
        },
    ),
    "token_transfers": SemanticModel(
        time="event_timestamp",
        dimensions=("transfer_id", "token_address", "token_symbol", "transfer_type", "event_date",
                    "from_address", "to_address"),
        measures={
            "transfer_volume_usd": ("sum", "amount_usd"),
            "transfer_count": ("count", "transfer_id"),
            "avg_transfer_usd": ("avg", "amount_usd"),
            "unique_senders": ("count_distinct", "from_address"),
            "unique_receivers": ("count_distinct", "to_address"),
        },
    ),
    "whale_movements": SemanticModel(
        time="event_timestamp",
        dimensions=("movement_id", "whale_direction", "token_symbol"),
        measures={
            "whale_volume_usd": ("sum", "amount_usd"),
            "whale_movement_count": ("count", "movement_id"),
        },
    ),
}


def _today(column: str) -> Callable[[date], Column]:
    return lambda day: F.to_date(column) == F.lit(day)


def _last_days(column: str, days: int) -> Callable[[date], Column]:
    return lambda day: F.to_date(column) >= F.lit(day - timedelta(days=days))


def _equals(column: str, *values: str) -> Callable[[date], Column]:
    return lambda day: F.col(column).isin(*values)


METRICS: dict[str, Metric | Ratio] = {
    "total_tvl_usd": Metric("address_positions", "total_collateral_usd"),
    "total_debt_usd": Metric("address_positions", "total_debt_usd"),
    "utilization_rate": Ratio("total_debt_usd", "total_tvl_usd"),
    "avg_health_factor": Metric("address_positions", "avg_health_factor"),
    "min_health_factor": Metric("address_positions", "min_health_factor"),
    "at_risk_tvl_usd": Metric("address_positions", "total_collateral_usd", _equals("risk_level", "CRITICAL", "LIQUIDATABLE")),
    "at_risk_ratio": Ratio("at_risk_tvl_usd", "total_tvl_usd"),
    "total_users": Metric("address_positions", "unique_users"),
    "total_positions": Metric("address_positions", "position_count"),
    "daily_active_users": Metric("token_transfers", "unique_senders", _today("event_date")),
    "total_transfer_volume_usd": Metric("token_transfers", "transfer_volume_usd"),
    "daily_volume_usd": Metric("token_transfers", "transfer_volume_usd", _today("event_date")),
    "weekly_volume_usd": Metric("token_transfers", "transfer_volume_usd", _last_days("event_date", 7)),
    "total_transfers": Metric("token_transfers", "transfer_count"),
    "avg_transfer_size_usd": Metric("token_transfers", "avg_transfer_usd"),
    "whale_positions_count": Metric("address_positions", "position_count", _equals("position_size_tier", "whale")),
    "whale_tvl_usd": Metric("address_positions", "total_collateral_usd", _equals("position_size_tier", "whale")),
    "whale_tvl_share": Ratio("whale_tvl_usd", "total_tvl_usd"),
    "whale_movement_volume_usd": Metric("whale_movements", "whale_volume_usd"),
    "whale_movement_count": Metric("whale_movements", "whale_movement_count"),
}

_AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "count": F.count,
    "count_distinct": F.count_distinct,
}


def _simple_parts(name: str) -> list[str]:
    definition = METRICS[name]
    if isinstance(definition, Ratio):
        return _simple_parts(definition.numerator) + _simple_parts(definition.denominator)
    return [name]


def _aggregate(model: SemanticModel, measure: str, condition: Column | None) -> Column:
    aggregate, column = model.measures[measure]
    value = F.col(column)
    if condition is not None:
        value = F.when(condition, value)
    result = _AGGREGATES[aggregate](value)
    return F.coalesce(result, F.lit(0)) if aggregate == "sum" and condition is not None else result


def _final(name: str) -> Column:
    definition = METRICS[name]
    if isinstance(definition, Ratio):
        below = _final(definition.denominator).cast("double")
        return _final(definition.numerator).cast("double") / F.nullif(below, F.lit(0.0))
    return F.col(f"_{name}")


def metrics(
    models: dict[str, DataFrame],
    names: list[str],
    group_by: tuple[str, ...] = (),
    grain: str | None = None,
    as_of: str | datetime | None = None,
) -> DataFrame:
    """Several metrics of one model side by side, computed in a single pass.

    Each metric applies its own filter inside the aggregate. A group is shown if
    some requested metric has rows in it; where all metrics are filtered, the
    rows that none of them takes are left out of the scan.
    """
    parts = sorted({part for name in names for part in _simple_parts(name)})
    used = {METRICS[part].model for part in parts}
    if len(used) != 1:
        raise ValueError(f"metrics of different models cannot share a query: {sorted(used)}")
    model_name = used.pop()
    model, df = MODELS[model_name], models[model_name]
    unknown = set(group_by) - set(model.dimensions)
    if unknown:
        raise ValueError(f"not a dimension of {model_name}: {sorted(unknown)}")
    if grain is not None and grain not in ("hour", "day", "week", "month", "year"):
        raise ValueError(f"unknown grain: {grain}")

    def condition(part: str) -> Column | None:
        rule = METRICS[part].condition
        if rule is None:
            return None
        if as_of is None and METRICS[part].model == "token_transfers":
            raise ValueError(f"{part} needs as_of")
        return rule(day_of(as_of) if as_of is not None else date.min)

    conditions = [condition(p) for p in parts]
    if all(c is not None for c in conditions):
        df = df.where(reduce(Column.__or__, conditions))
    keys = [F.col(c) for c in group_by]
    if grain:
        keys.append(F.date_trunc(grain, model.time).alias("metric_time"))
    grouped = df.groupBy(*keys).agg(
        *[_aggregate(model, METRICS[p].measure, condition(p)).alias(f"_{p}") for p in parts]
    )
    heads = [*group_by, *(["metric_time"] if grain else [])]
    return grouped.select(*heads, *[_final(name).alias(name) for name in names])


def metric(
    models: dict[str, DataFrame],
    name: str,
    group_by: tuple[str, ...] = (),
    grain: str | None = None,
    as_of: str | datetime | None = None,
) -> DataFrame:
    return metrics(models, [name], group_by, grain, as_of)


def measure(df: DataFrame, model_name: str, name: str, group_by: tuple[str, ...] = (), grain: str | None = None) -> DataFrame:
    """A bare measure by any dimensions of its model."""
    model = MODELS[model_name]
    keys = [F.col(c) for c in group_by]
    if grain:
        keys.append(F.date_trunc(grain, model.time).alias("metric_time"))
    return df.groupBy(*keys).agg(_aggregate(model, name, None).alias(name))
