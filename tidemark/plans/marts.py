"""Summary marts over the core tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULTS, RISK_LEVELS, Settings
from tidemark.functions.risk import utilization
from tidemark.functions.values import day_of, moment, sum_if, sum_or_zero

# Position size tiers from largest to smallest.
SIZE_TIERS = ("whale", "large", "medium", "small")


def _counts(column: str, values: tuple[str, ...]) -> list[Column]:
    return [F.count_if(F.col(column) == v).alias(f"{v.lower()}_positions") for v in values]


def protocol_summary(
    address_positions: DataFrame, events: DataFrame, as_of: str | datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    """Positions per protocol with the activity of the last 7 and 30 days.

    The 7-day figures are conditional aggregates of the 30-day slice, so the
    events are read once.
    """
    today = day_of(as_of)
    week = F.col("event_date") >= F.lit(today - timedelta(days=7))
    usd, kind = F.col("amount_usd"), F.col("event_type")
    activity = (
        events.where(F.col("event_date") >= F.lit(today - timedelta(days=30)))
        .groupBy("protocol")
        .agg(
            F.count_if(week).alias("events_7d"),
            F.count_distinct(F.when(week, F.col("user_address"))).alias("active_users_7d"),
            sum_if(usd, week).alias("volume_7d"),
            sum_if(usd, week & (kind == "supply")).alias("supply_volume_7d"),
            sum_if(usd, week & (kind == "borrow")).alias("borrow_volume_7d"),
            F.count_if(week & (kind == "liquidation")).alias("liquidations_7d"),
            F.count(F.lit(1)).alias("events_30d"),
            F.count_distinct("user_address").alias("active_users_30d"),
            F.sum(usd).alias("volume_30d"),
        )
    )
    positions = address_positions.groupBy("protocol").agg(
        F.count_distinct("user_address").alias("unique_users"),
        F.sum("total_collateral_usd").alias("total_tvl_usd"),
        F.sum("total_debt_usd").alias("total_debt_usd"),
        F.avg("health_factor").alias("avg_health_factor"),
        F.min("health_factor").alias("min_health_factor"),
        *_counts("risk_level", RISK_LEVELS),
        *_counts("position_size_tier", SIZE_TIERS),
    )
    active = [c for c in activity.columns if c != "protocol"]
    return positions.join(activity, "protocol", "left").select(
        "protocol",
        F.lit(settings.chain).alias("chain"),
        "unique_users",
        "total_tvl_usd",
        "total_debt_usd",
        utilization(F.col("total_debt_usd"), F.col("total_tvl_usd")).alias("utilization_rate"),
        "avg_health_factor",
        "min_health_factor",
        *[f"{level.lower()}_positions" for level in RISK_LEVELS],
        (F.col("critical_positions") + F.col("liquidatable_positions")).alias("at_risk_positions"),
        *[f"{tier}_positions" for tier in SIZE_TIERS],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in active],
        moment(as_of).alias("snapshot_time"),
    )


def ecosystem_kpis(address_positions: DataFrame, transfers: DataFrame, as_of: str | datetime) -> DataFrame:
    """One row of positions and today's activity, each side one scalar subquery.

    Sums over an empty day are 0; the active users of a day without transfers are NULL.
    """
    spark = address_positions.sparkSession
    at_risk = F.col("risk_level").isin("CRITICAL", "LIQUIDATABLE")
    held = address_positions.agg(
        F.struct(
            F.count(F.lit(1)).alias("total_positions"),
            F.count_distinct("user_address").alias("unique_users"),
            sum_or_zero(F.col("total_collateral_usd")).alias("total_tvl"),
            sum_or_zero(F.col("total_debt_usd")).alias("total_debt"),
            F.avg("health_factor").alias("avg_health_factor"),
            F.count_if(at_risk).alias("at_risk_positions"),
        ).alias("p")
    )
    day = transfers.where(F.col("event_date") == F.lit(day_of(as_of))).agg(
        F.struct(
            sum_or_zero(F.col("amount_usd")).alias("volume_24h"),
            F.count(F.lit(1)).alias("transfers_24h"),
            F.when(F.count(F.lit(1)) > 0, F.count_distinct("from_address")).alias("active_users_24h"),
        ).alias("d")
    )
    one = spark.range(1).select(held.scalar().alias("p"), day.scalar().alias("d"))
    return one.select(
        F.lit("ecosystem_summary").alias("metric_type"),
        moment(as_of).alias("snapshot_time"),
        "p.*",
        "d.*",
    )


def token_breakdown_daily(transfers: DataFrame, as_of: str | datetime, days: int = 30) -> DataFrame:
    """Daily transfer volume with the share of the two main tokens."""
    symbol, usd = F.col("token_symbol"), F.col("amount_usd")
    return (
        transfers.where(F.col("event_date") >= F.lit(day_of(as_of) - timedelta(days=days)))
        .groupBy("event_date")
        .agg(
            F.count_distinct("from_address").alias("unique_senders"),
            F.count_distinct("to_address").alias("unique_receivers"),
            F.count(F.lit(1)).alias("transfer_count"),
            F.sum(usd).alias("volume_usd"),
            F.count_if(symbol == "USDC").alias("usdc_transfers"),
            sum_if(usd, symbol == "USDC").alias("usdc_volume"),
            F.count_if(symbol == "WETH").alias("weth_transfers"),
            sum_if(usd, symbol == "WETH").alias("weth_volume"),
        )
    )


def event_volume_daily(events: DataFrame, as_of: str | datetime, days: int = 30) -> DataFrame:
    return (
        events.where(F.col("event_date") >= F.lit(day_of(as_of) - timedelta(days=days)))
        .groupBy("event_date", "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"), F.sum("amount_usd").alias("volume_usd"))
    )


def risk_distribution(rt_risk: DataFrame) -> DataFrame:
    """Accounts per level, one column each, over the latest risk rows."""
    return rt_risk.agg(*[F.count_if(F.col("risk_level") == v).alias(v.lower()) for v in RISK_LEVELS])


def risk_distribution_long(address_positions: DataFrame) -> DataFrame:
    return address_positions.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("user_count"),
        F.sum("total_collateral_usd").alias("total_collateral_usd"),
        F.sum("total_debt_usd").alias("total_debt_usd"),
        F.avg("health_factor").alias("avg_health_factor"),
        F.min("health_factor").alias("min_health_factor"),
    )


def size_distribution(address_positions: DataFrame) -> DataFrame:
    return address_positions.groupBy("position_size_tier").agg(
        F.count(F.lit(1)).alias("user_count"),
        F.sum("total_collateral_usd").alias("total_collateral_usd"),
        F.avg("health_factor").alias("avg_health_factor"),
    )


def risk_dashboard(address_positions: DataFrame, as_of: str | datetime) -> DataFrame:
    """Summary, risk and size sections as (section, metric, text value).

    All sections roll up from one aggregate over (level, tier), at most
    twenty rows, instead of scanning the positions once per section.
    """
    cells = address_positions.groupBy("risk_level", "position_size_tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_collateral_usd").alias("tvl"),
        F.sum("total_debt_usd").alias("debt"),
        F.sum("health_factor").alias("health"),
        F.count("health_factor").alias("health_n"),
    )
    total = cells.agg(
        F.collect_list(F.struct("risk_level", "position_size_tier", "n")).alias("cells"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("tvl").cast("decimal(38,2)").alias("tvl"),
        F.sum("debt").cast("decimal(38,2)").alias("debt"),
        (F.sum("health") / F.sum("health_n")).cast("decimal(18,6)").alias("health"),
    )

    def line(section: str, name: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), name.alias("metric_name"), value.cast("string").alias("metric_value")
        )

    def counts(section: str, field: str) -> Column:
        names = F.array_distinct(F.transform("cells", lambda c: c[field]))
        return F.transform(
            names,
            lambda name: line(
                section,
                name,
                F.aggregate(
                    F.filter("cells", lambda c: c[field] == name),
                    F.lit(0).cast("bigint"),
                    lambda n, c: n + c["n"],
                ),
            ),
        )

    lines = F.concat(
        F.array(
            line("summary", F.lit("total_users"), F.col("n")),
            line("summary", F.lit("total_tvl_usd"), F.col("tvl")),
            line("summary", F.lit("total_debt_usd"), F.col("debt")),
            line("summary", F.lit("avg_health_factor"), F.col("health")),
        ),
        counts("risk_distribution", "risk_level"),
        counts("size_distribution", "position_size_tier"),
    )
    return total.select(F.inline(lines), moment(as_of).alias("snapshot_time"))
