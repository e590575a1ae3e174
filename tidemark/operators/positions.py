"""Latest position per account, joined with its real-time risk level."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULTS, Settings
from tidemark.functions.risk import risk_level, size_tier, utilization
from tidemark.functions.values import dash_key, from_millis, moment
from tidemark.operators.versions import latest_by, latest_version

ACCOUNT = ["chain", "protocol", "user_address"]


def latest_positions(raw_positions: DataFrame) -> DataFrame:
    """Newest snapshot of each account by block, then by time and value."""
    return latest_by(
        raw_positions,
        ACCOUNT,
        [
            F.col("block_number").desc(),
            F.col("timestamp").desc(),
            F.col("total_collateral_usd").desc(),
            F.col("total_debt_usd").desc(),
            F.col("health_factor"),
        ],
    )


def address_positions(
    raw_positions: DataFrame,
    rt_risk: DataFrame,
    as_of: str | datetime,
    settings: Settings = DEFAULTS,
    above_block: int | None = None,
) -> DataFrame:
    """Enriched positions. `above_block` is the high-water mark of an incremental run.

    Both sides are keyed by account, so the latest-row step and the join share
    one partitioning and the join adds no shuffle of its own.
    """
    if above_block is not None:
        raw_positions = raw_positions.where(F.col("block_number") > above_block)
    p = latest_positions(raw_positions).alias("p")
    r = (
        latest_version(rt_risk, ACCOUNT, "version")
        .select(*ACCOUNT, F.col("risk_level").alias("rt_level"), "previous_risk_level", "risk_changed_at")
        .alias("r")
    )
    collateral, debt = F.col("total_collateral_usd"), F.col("total_debt_usd")
    return p.join(r, ACCOUNT, "left").select(
        dash_key(*ACCOUNT).alias("position_key"),
        *ACCOUNT,
        "health_factor",
        "total_collateral_usd",
        "total_debt_usd",
        "available_borrow_usd",
        "ltv",
        "liquidation_threshold",
        F.coalesce("rt_level", risk_level(F.col("health_factor"), settings)).alias("risk_level"),
        "previous_risk_level",
        "risk_changed_at",
        size_tier(collateral, settings).alias("position_size_tier"),
        utilization(debt, collateral).alias("utilization_rate"),
        "block_number",
        from_millis(F.col("timestamp")).alias("position_timestamp"),
        moment(as_of).alias("dbt_updated_at"),
    )
