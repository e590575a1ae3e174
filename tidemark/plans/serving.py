"""Parameterised questions over the core and mart tables.

Parameters are clamped the way the public API clamps them; each function
returns a lazy DataFrame, so filters and column choices reach the scan.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.risk import risk_rank, size_tier, utilization
from tidemark.functions.values import day_of, moment, money_text, number_text
from tidemark.operators.positions import ACCOUNT
from tidemark.operators.versions import latest_version
from tidemark.plans.marts import risk_distribution

Moment = str | datetime


def given(value: int | None, default: int) -> int:
    """What was asked for, or the default for nothing and for values that aren't positive."""
    return default if value is None or value <= 0 else value


def checked_address(address: str) -> str:
    if not re.fullmatch(r"0x[a-fA-F0-9]{40}", address):
        raise ValueError(f"invalid address: {address!r}")
    return address.lower()


def _risk_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "chain",
        "protocol",
        F.col("user_address").alias("address"),
        "health_factor",
        "risk_level",
        F.col("total_collateral_usd").cast("string").alias("total_collateral_usd"),
        F.col("total_debt_usd").cast("string").alias("total_debt_usd"),
        F.col("available_borrow_usd").cast("string").alias("available_borrow_usd"),
        "ltv",
        "liquidation_threshold",
        "updated_at",
    )


def address_risk(rt_risk: DataFrame, address: str) -> DataFrame:
    """The newest risk row of one address with its tier and utilisation.

    The address filter comes first, so only its rows are merged and sorted.
    """
    mine = rt_risk.where(F.col("user_address") == checked_address(address))
    newest = (
        latest_version(mine, ACCOUNT, "version")
        .orderBy(F.col("updated_at").desc(), F.col("version").desc(), "protocol", "chain")
        .limit(1)
    )
    collateral = F.col("total_collateral_usd").cast("double")
    return (
        _risk_rows(newest)
        .withColumn("position_size_tier", size_tier(collateral))
        .withColumn("utilization_rate", utilization(F.col("total_debt_usd").cast("double"), collateral))
    )


def address_positions_of(rt_risk: DataFrame, address: str) -> DataFrame:
    return address_risk(rt_risk, address)


def high_risk(
    rt_risk: DataFrame, level: str = "CRITICAL", limit: int | None = 100, min_collateral: float = 1000
) -> DataFrame:
    """The riskiest accounts of one level above a collateral floor."""
    if level not in ("CRITICAL", "LIQUIDATABLE", "DANGER"):
        level = "CRITICAL"
    if min_collateral < 0:
        min_collateral = 1000
    rows = latest_version(rt_risk, ACCOUNT, "version").where(
        (F.col("risk_level") == level) & (F.col("total_collateral_usd") >= min_collateral)
    )
    top = rows.orderBy("health_factor", "user_address", "protocol", "chain").limit(given(limit, 100))
    return _risk_rows(top)


def current_risk_distribution(rt_risk: DataFrame) -> DataFrame:
    return risk_distribution(latest_version(rt_risk, ACCOUNT, "version"))


def address_flow(
    netflow: DataFrame, address: str, as_of: Moment, days: int | None = 30, token: str | None = None
) -> DataFrame:
    """Daily flow of one address, newest first, as two-decimal texts."""
    return (
        _address_days(netflow, address, as_of, days, token)
        .orderBy(F.col("event_date").desc())
        .select(
            F.col("event_date").cast("string").alias("date"),
            money_text(F.col("inflow_usd")).alias("inflow_usd"),
            money_text(F.col("outflow_usd")).alias("outflow_usd"),
            money_text(F.col("net_usd")).alias("net_usd"),
        )
    )


def address_flow_totals(
    netflow: DataFrame, address: str, as_of: Moment, days: int | None = 30, token: str | None = None
) -> DataFrame:
    """Totals over the same days; one row even for an address without flow."""
    period = given(days, 30)
    total_in = F.coalesce(F.sum("inflow_usd"), F.lit(0.0))
    total_out = F.coalesce(F.sum("outflow_usd"), F.lit(0.0))
    return _address_days(netflow, address, as_of, days, token).agg(
        F.lit(checked_address(address)).alias("address"),
        F.lit(period).alias("period_days"),
        money_text(total_in).alias("total_inflow_usd"),
        money_text(total_out).alias("total_outflow_usd"),
        money_text(total_in - total_out).alias("net_flow_usd"),
    )


def _address_days(netflow, address, as_of, days, token) -> DataFrame:
    first = day_of(as_of) - timedelta(days=given(days, 30))
    rows = netflow.where(
        (F.col("address") == checked_address(address)) & (F.col("event_date") >= F.lit(first))
    )
    if token:
        rows = rows.where(F.col("token_address") == checked_address(token))
    return rows.groupBy("event_date").agg(
        F.sum("inflow_usd").alias("inflow_usd"),
        F.sum("outflow_usd").alias("outflow_usd"),
        F.sum("net_usd").alias("net_usd"),
    )


def _movements(mart, as_of, hours, min_usd, direction) -> DataFrame:
    hours = given(hours, 24)
    if min_usd is None or min_usd < 0:
        min_usd = 100_000
    since = moment(as_of) - F.expr(f"interval {hours} hours")
    rows = mart.where((F.col("event_timestamp") >= since) & (F.col("amount_usd") >= min_usd))
    if direction in ("in", "out"):
        rows = rows.where(F.col("whale_direction") == f"whale_{direction}")
    return rows


def _newest(rows: DataFrame, limit: int) -> DataFrame:
    return rows.orderBy(
        F.col("event_timestamp").desc(), "tx_hash", "movement_id", F.col("amount_usd").desc(), "from_address",
        "to_address",
    ).limit(limit)


def whale_movements_list(
    mart: DataFrame,
    as_of: Moment,
    hours: int | None = 24,
    min_usd: float | None = 100_000,
    direction: str = "all",
    limit: int = 1000,
) -> DataFrame:
    """Newest large movements."""
    return _newest(_movements(mart, as_of, hours, min_usd, direction), limit).select(
        F.col("event_timestamp").alias("timestamp"),
        "from_address",
        "to_address",
        "token_symbol",
        number_text(F.col("amount")).alias("amount"),
        number_text(F.col("amount_usd")).alias("amount_usd"),
        F.col("whale_direction").alias("direction"),
        "tx_hash",
    )


def whale_movements_totals(
    mart: DataFrame,
    as_of: Moment,
    hours: int | None = 24,
    min_usd: float | None = 100_000,
    direction: str = "all",
) -> DataFrame:
    """Count and volume of all movements that match; a limit belongs to the list alone."""
    return _movements(mart, as_of, hours, min_usd, direction).agg(
        F.lit(given(hours, 24)).alias("period_hours"),
        F.count(F.lit(1)).alias("total_movements"),
        money_text(F.coalesce(F.sum("amount_usd"), F.lit(0.0))).alias("total_volume_usd"),
    )


def whale_list(whales: DataFrame, limit: int | None = 100) -> DataFrame:
    return (
        whales.orderBy(F.col("max_whale_value_usd").desc(), "address")
        .limit(given(limit, 100))
        .select("address", "whale_types", "max_whale_value_usd", "is_position_whale", "is_transfer_whale")
    )


def ecosystem_stats(kpis: DataFrame, rt_risk: DataFrame) -> DataFrame:
    """The KPI row with the current risk distribution beside it (a scalar subquery)."""
    levels = ("safe", "warning", "danger", "critical", "liquidatable")
    spread = current_risk_distribution(rt_risk).select(F.struct(*levels).alias("r"))
    return kpis.limit(1).select(
        "snapshot_time",
        F.col("total_tvl").cast("string").alias("total_tvl_usd"),
        F.col("total_debt").cast("string").alias("total_debt_usd"),
        F.col("unique_users").alias("total_users"),
        "active_users_24h",
        money_text(F.col("volume_24h")).alias("volume_24h_usd"),
        "avg_health_factor",
        "at_risk_positions",
        spread.scalar().alias("_r"),
    ).select("*", "_r.*").drop("_r")


def tvl_history(cdp_metrics: DataFrame, as_of: Moment, days: int | None = 30) -> DataFrame:
    """Total value locked, debt and users per day."""
    first = day_of(as_of) - timedelta(days=given(days, 30))
    return (
        cdp_metrics.where(F.col("metrics_date") >= F.lit(first))
        .groupBy("metrics_date")
        .agg(
            F.sum("total_tvl_usd").alias("total_tvl"),
            F.sum("total_debt_usd").alias("total_debt"),
            F.sum("total_users").alias("total_users"),
        )
        .orderBy("metrics_date")
    )


def _last_hours(transfers: DataFrame, as_of: Moment, hours: int) -> DataFrame:
    """The date condition is implied by the time condition; it prunes date partitions."""
    first_day = day_of(as_of) - timedelta(days=hours // 24 + 1)
    return transfers.where(
        (F.col("event_date") >= F.lit(first_day))
        & (F.col("event_timestamp") >= moment(as_of) - F.expr(f"interval {hours} hours"))
    )


def hourly_volume(transfers: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    return (
        _last_hours(transfers, as_of, hours)
        .groupBy(F.col("event_hour").alias("hour"))
        .agg(
            F.sum("amount_usd").alias("volume_usd"),
            F.count(F.lit(1)).alias("transfer_count"),
            (F.count_distinct("from_address") + F.count_distinct("to_address")).alias("unique_addresses"),
        )
        .orderBy("hour")
    )


def token_distribution(transfers: DataFrame, as_of: Moment, hours: int = 24, limit: int = 10) -> DataFrame:
    return (
        _last_hours(transfers, as_of, hours)
        .groupBy("token_symbol")
        .agg(
            F.sum("amount_usd").alias("total_volume"),
            F.count(F.lit(1)).alias("transfer_count"),
            F.count_distinct("from_address").alias("unique_senders"),
        )
        .orderBy(F.col("total_volume").desc(), "token_symbol")
        .limit(limit)
    )


def risk_summary(address_positions: DataFrame) -> DataFrame:
    """Distribution by level, safest first."""
    return (
        address_positions.groupBy("risk_level")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.sum("total_collateral_usd").alias("total_collateral"),
            F.sum("total_debt_usd").alias("total_debt"),
            F.avg("health_factor").alias("avg_health_factor"),
        )
        .orderBy(risk_rank(F.col("risk_level")))
    )


def high_risk_positions(address_positions: DataFrame, min_collateral: float = 1000, limit: int = 100) -> DataFrame:
    return (
        address_positions.where(
            F.col("risk_level").isin("CRITICAL", "LIQUIDATABLE", "DANGER")
            & (F.col("total_collateral_usd") >= min_collateral)
        )
        .orderBy("health_factor", "position_key")
        .limit(limit)
        .select(
            "user_address",
            "health_factor",
            "risk_level",
            "total_collateral_usd",
            "total_debt_usd",
            "utilization_rate",
            "position_timestamp",
        )
    )


def health_trend(cdp_metrics: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    return (
        cdp_metrics.where(F.col("metrics_date") >= F.lit(day_of(as_of) - timedelta(days=days)))
        .select(
            "metrics_date",
            "protocol",
            "avg_health_factor",
            "min_health_factor",
            "critical_positions",
            "liquidatable_positions",
        )
        .orderBy("metrics_date", "protocol")
    )


def large_whale_moves(
    mart: DataFrame, as_of: Moment, hours: int = 24, min_usd: float = 100_000, limit: int = 100
) -> DataFrame:
    return _newest(_movements(mart, as_of, hours, min_usd, "all"), limit).select(
        "event_timestamp",
        "from_address",
        "to_address",
        "token_symbol",
        "amount",
        "amount_usd",
        "whale_direction",
        "tx_hash",
    )


def latest_kpis(kpis: DataFrame) -> DataFrame:
    return (
        kpis.where(F.col("metric_type") == "ecosystem_summary")
        .orderBy(F.col("snapshot_time").desc())
        .limit(1)
        .select(
            "total_positions",
            "unique_users",
            "total_tvl",
            "total_debt",
            "avg_health_factor",
            "at_risk_positions",
            "volume_24h",
            "transfers_24h",
            "active_users_24h",
        )
    )


def protocol_comparison(summary: DataFrame) -> DataFrame:
    return summary.select(
        "protocol",
        "unique_users",
        "total_tvl_usd",
        "total_debt_usd",
        "utilization_rate",
        "avg_health_factor",
        "at_risk_positions",
    ).orderBy(F.col("total_tvl_usd").desc(), "protocol")


def reserves(table: DataFrame, symbol: str) -> DataFrame:
    """The reserve with a symbol; the first by id where several share it."""
    return table.where(F.col("symbol") == symbol).orderBy("id").limit(1)


def user_reserves(table: DataFrame, user: str) -> DataFrame:
    return table.where(F.col("user_address") == user.lower())
