"""Cleaned views over the raw tables.

Each function is one projection with one filter, so the scan reads only the
columns a query ends up using. `start` and `end` bound the raw epoch
milliseconds directly: that comparison reaches the Parquet footers, which a
condition on the derived date would not.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULTS
from tidemark.functions.addresses import ZERO_ADDRESS
from tidemark.functions.values import dash_key, date_of_millis, from_millis, hour_of_millis, moment_ms

Bound = str | datetime | None


def bounded(raw: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    """Rows with start <= timestamp < end."""
    if start is not None:
        raw = raw.where(F.col("timestamp") >= F.lit(moment_ms(start)))
    if end is not None:
        raw = raw.where(F.col("timestamp") < F.lit(moment_ms(end)))
    return raw


def _or(column: str, default: object) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def stg_blocks(raw: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    used, limit = F.col("gas_used"), F.col("gas_limit")
    return bounded(raw, start, end).where(F.col("block_number") > 0).select(
        "block_number",
        F.lower("block_hash").alias("block_hash"),
        F.lower(_or("parent_hash", "")).alias("parent_hash"),
        from_millis(F.col("timestamp")).alias("block_timestamp"),
        date_of_millis(F.col("timestamp")).alias("block_date"),
        hour_of_millis(F.col("timestamp")).alias("block_hour"),
        F.coalesce(used, F.lit(0).cast("bigint")).alias("gas_used"),
        F.coalesce(limit, F.lit(0).cast("bigint")).alias("gas_limit"),
        F.when(limit > 0, used.cast("double") / limit.cast("double")).otherwise(F.lit(0.0)).alias("gas_utilization"),
        _or("transaction_count", 0).alias("transaction_count"),
        F.coalesce(F.col("base_fee_per_gas").try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias(
            "base_fee_per_gas"
        ),
        F.lower(_or("miner", "")).alias("miner_address"),
        F.col("timestamp").alias("timestamp_ms"),
        "kafka_offset",
        "kafka_partition",
    )


def stg_lending_events(
    raw: DataFrame, chain: str = DEFAULTS.chain, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Amounts beyond 38 digits leave `amount_raw` NULL; `amount_text` always has the full value."""
    return bounded(raw, start, end).where((F.col("chain") == chain) & (F.col("timestamp") > 0)).select(
        dash_key("chain", "block_number", "log_index").alias(
            "event_id"
        ),
        F.lower("chain").alias("chain"),
        F.lower("protocol").alias("protocol"),
        F.lower("event_type").alias("event_type"),
        F.lower("user_address").alias("user_address"),
        F.lower(_or("asset_address", "")).alias("asset_address"),
        F.upper(_or("asset_symbol", "UNKNOWN")).alias("asset_symbol"),
        _or("amount", "0").try_cast("decimal(38,18)").alias("amount_raw"),
        _or("amount", "0").alias("amount_text"),
        _or("amount_usd", 0.0).alias("amount_usd"),
        F.lower(_or("liquidator_address", "")).alias("liquidator_address"),
        F.lower(_or("collateral_asset", "")).alias("collateral_asset"),
        F.lower(_or("debt_asset", "")).alias("debt_asset"),
        "block_number",
        F.lower("tx_hash").alias("tx_hash"),
        "log_index",
        from_millis(F.col("timestamp")).alias("event_timestamp"),
        date_of_millis(F.col("timestamp")).alias("event_date"),
        "kafka_offset",
        "kafka_partition",
    )


def stg_positions(
    raw: DataFrame, chain: str = DEFAULTS.chain, start: Bound = None, end: Bound = None
) -> DataFrame:
    def money(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0).cast("decimal(38,8)")).cast("decimal(38,2)").alias(column)

    return bounded(raw, start, end).where((F.col("chain") == chain) & (F.col("user_address") != "")).select(
        dash_key("chain", "protocol", "user_address", "block_number").alias(
            "position_id"
        ),
        F.lower("chain").alias("chain"),
        F.lower("protocol").alias("protocol"),
        F.lower("user_address").alias("user_address"),
        _or("health_factor", 999.0).alias("health_factor"),
        money("total_collateral_usd"),
        money("total_debt_usd"),
        money("available_borrow_usd"),
        _or("ltv", 0.0).alias("ltv"),
        _or("liquidation_threshold", 0.0).alias("liquidation_threshold"),
        _or("collateral_assets", "[]").alias("collateral_assets"),
        _or("debt_assets", "[]").alias("debt_assets"),
        "block_number",
        from_millis(F.col("timestamp")).alias("position_timestamp"),
        date_of_millis(F.col("timestamp")).alias("position_date"),
        F.col("timestamp").alias("timestamp_ms"),
        "kafka_offset",
        "kafka_partition",
    )


def stg_transfers(
    raw: DataFrame, chain: str = DEFAULTS.chain, start: Bound = None, end: Bound = None
) -> DataFrame:
    decimals = _or("token_decimals", 18)
    unscaled = F.col("amount_raw").try_cast("double") / F.pow(F.lit(10.0), decimals)
    return bounded(raw, start, end).where(F.col("chain") == chain).select(
        F.coalesce(
            "transfer_id", dash_key("chain", "tx_hash", "log_index")
        ).alias("transfer_id"),
        F.lower("chain").alias("chain"),
        F.lower("token_address").alias("token_address"),
        F.upper(_or("token_symbol", "UNKNOWN")).alias("token_symbol"),
        decimals.alias("token_decimals"),
        F.lower("from_address").alias("from_address"),
        F.lower("to_address").alias("to_address"),
        "amount_raw",
        F.coalesce(F.col("amount"), unscaled).alias("amount"),
        _or("amount_usd", 0.0).alias("amount_usd"),
        F.when(F.col("from_address") == ZERO_ADDRESS, "mint")
        .when(F.col("to_address") == ZERO_ADDRESS, "burn")
        .otherwise("transfer")
        .alias("transfer_type"),
        "block_number",
        F.lower("tx_hash").alias("tx_hash"),
        "log_index",
        from_millis(F.col("timestamp")).alias("event_timestamp"),
        date_of_millis(F.col("timestamp")).alias("event_date"),
        hour_of_millis(F.col("timestamp")).alias("event_hour"),
    )


def stg_prices(raw: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    def money(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0).cast("decimal(38,2)")).alias(column)

    return bounded(raw, start, end).where((F.col("price_usd") > 0) & (F.col("token_address") != "")).select(
        dash_key("chain", "token_address", "timestamp").alias("price_id"),
        F.lower(_or("chain", DEFAULTS.chain)).alias("chain"),
        F.lower("token_address").alias("token_address"),
        F.upper(_or("token_symbol", "UNKNOWN")).alias("token_symbol"),
        "price_usd",
        _or("price_eth", 0.0).alias("price_eth"),
        money("market_cap_usd"),
        money("volume_24h_usd"),
        _or("price_change_24h_pct", 0.0).alias("price_change_24h_pct"),
        _or("price_source", "unknown").alias("price_source"),
        from_millis(F.col("timestamp")).alias("price_timestamp"),
        date_of_millis(F.col("timestamp")).alias("price_date"),
        hour_of_millis(F.col("timestamp")).alias("price_hour"),
        F.col("timestamp").alias("timestamp_ms"),
    )
