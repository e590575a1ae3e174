"""Daily lending metrics from events and position snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULTS, Settings
from tidemark.functions.risk import utilization
from tidemark.functions.values import dash_key, moment, sum_if
from tidemark.operators.versions import latest_by

# Event types with a count and a volume column of their own.
PIVOTED_EVENTS = ("supply", "withdraw", "borrow", "repay", "liquidation")


def daily_events(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("event_date").alias("metrics_date"), "protocol", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("user_address").alias("unique_users"),
        F.sum("amount_usd").alias("volume_usd"),
        F.avg("amount_usd").alias("avg_amount_usd"),
    )


def event_pivot(daily: DataFrame) -> DataFrame:
    """Fixed pivot; other event types count only towards the active users."""
    columns = []
    for name in PIVOTED_EVENTS:
        is_type = F.col("event_type") == name
        columns.append(sum_if(F.col("event_count"), is_type).alias(f"{name}_count"))
        columns.append(sum_if(F.col("volume_usd"), is_type).alias(f"{name}_volume_usd"))
    return daily.groupBy("metrics_date", "protocol").agg(
        *columns, F.sum("unique_users").alias("total_active_users")
    )


def daily_positions(
    positions: DataFrame, latest_only: bool = False, settings: Settings = DEFAULTS
) -> DataFrame:
    """Per day and protocol. All snapshots of the day count, unless `latest_only`."""
    if latest_only:
        positions = latest_by(
            positions,
            ["position_date", "chain", "protocol", "user_address"],
            [F.col("block_number").desc(), F.col("timestamp_ms").desc(), F.col("total_collateral_usd").desc()],
        )
    health = F.col("health_factor")
    return positions.groupBy(F.col("position_date").alias("metrics_date"), "protocol").agg(
        F.count_distinct("user_address").alias("total_users"),
        F.sum("total_collateral_usd").alias("total_tvl_usd"),
        F.sum("total_debt_usd").alias("total_debt_usd"),
        F.avg("health_factor").alias("avg_health_factor"),
        F.min("health_factor").alias("min_health_factor"),
        F.count_if(health < settings.health_critical).alias("critical_positions"),
        F.count_if(health < 1.0).alias("liquidatable_positions"),
    )


def cdp_metrics_daily(
    events: DataFrame,
    positions: DataFrame,
    as_of: str | datetime,
    latest_only: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    p = daily_positions(positions, latest_only, settings)
    e = event_pivot(daily_events(events))

    def event(column: str):
        return F.coalesce(F.col(column), F.lit(0))

    pivoted = [
        event(f"{name}_{suffix}").alias(f"{name}_{suffix}")
        for name in PIVOTED_EVENTS
        for suffix in ("count", "volume_usd")
    ]
    return p.join(e, ["metrics_date", "protocol"], "left").select(
        dash_key("metrics_date", "protocol").alias("metrics_key"),
        F.lit(settings.chain).alias("chain"),
        "metrics_date",
        "protocol",
        "total_users",
        "total_tvl_usd",
        "total_debt_usd",
        "avg_health_factor",
        "min_health_factor",
        "critical_positions",
        "liquidatable_positions",
        *pivoted,
        (event("supply_volume_usd") - event("withdraw_volume_usd")).alias("net_supply_usd"),
        (event("borrow_volume_usd") - event("repay_volume_usd")).alias("net_borrow_usd"),
        utilization(F.col("total_debt_usd"), F.col("total_tvl_usd")).alias("utilization_rate"),
        moment(as_of).alias("dbt_updated_at"),
    )


def recent_liquidations(events: DataFrame, since: str | datetime, limit: int = 1000) -> DataFrame:
    """Newest liquidations since a moment."""
    return (
        events.where((F.col("event_type") == "liquidation") & (F.col("event_timestamp") >= moment(since)))
        .orderBy(F.col("event_timestamp").desc(), "event_id", "tx_hash")
        .limit(limit)
        .select(
            "event_id",
            "user_address",
            "liquidator_address",
            "collateral_asset",
            "debt_asset",
            "amount_text",
            "amount_usd",
            "event_timestamp",
            "tx_hash",
        )
    )
