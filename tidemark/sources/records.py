"""Typed records out of JSON text, with the lenient defaults of the stream readers.

Unknown fields are ignored and missing ones take a default. A record without
a usable timestamp keeps NULL there, so that a replay gives the same rows;
callers reject it instead of stamping it with the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import dash_key

NO_DEBT_HEALTH = 999.0

_POSITION_JSON = """
    chain string, protocol string, user_address string, block_number bigint,
    total_collateral_eth string, total_debt_eth string, available_borrow_eth string,
    health_factor double, ltv double, liquidation_threshold double,
    current_liquidation_threshold double, total_collateral_usd double, total_debt_usd double,
    available_borrow_usd double, timestamp string
"""
_PRICE_JSON = """
    chain string, asset_symbol string, asset_address string, price_usd double,
    source string, timestamp string
"""
_TRANSFER_JSON = """
    transfer_id string, chain string, token_address string, token_symbol string,
    token_decimals int, from_address string, to_address string, amount_raw string,
    amount double, amount_usd double, block_number bigint, tx_hash string, log_index int,
    timestamp string
"""


def _opened(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """Parse `column` into a struct named `r`, keeping only rows that are JSON objects."""
    parsed = F.from_json(F.col(column), ddl, {"mode": "PERMISSIVE"})
    return df.where(F.col(column).isNotNull()).select(parsed.alias("r")).where(F.col("r").isNotNull())


def _millis(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.unix_millis(F.try_to_timestamp(text)))


def _text(name: str, default: str = "") -> Column:
    return F.coalesce(F.col(f"r.{name}"), F.lit(default))


def _usd(name: str) -> Column:
    return F.coalesce(F.col(f"r.{name}"), F.lit(0.0)).cast("decimal(38,8)")


def parse_positions(df: DataFrame, column: str = "value") -> DataFrame:
    r = _opened(df, column, _POSITION_JSON)
    return r.select(
        _text("chain", "base").alias("chain"),
        _text("protocol", "aave_v3").alias("protocol"),
        _text("user_address").alias("user_address"),
        F.coalesce("r.block_number", F.lit(0).cast("bigint")).alias("block_number"),
        _text("total_collateral_eth", "0").alias("total_collateral_eth"),
        _text("total_debt_eth", "0").alias("total_debt_eth"),
        _text("available_borrow_eth", "0").alias("available_borrow_eth"),
        F.coalesce("r.health_factor", F.lit(NO_DEBT_HEALTH)).alias("health_factor"),
        F.coalesce("r.ltv", F.lit(0.0)).alias("ltv"),
        F.coalesce(
            "r.liquidation_threshold", "r.current_liquidation_threshold", F.lit(0.0)
        ).alias("liquidation_threshold"),
        _usd("total_collateral_usd").alias("total_collateral_usd"),
        _usd("total_debt_usd").alias("total_debt_usd"),
        _usd("available_borrow_usd").alias("available_borrow_usd"),
        _millis(F.col("r.timestamp")).alias("timestamp"),
    )


def parse_prices(df: DataFrame, column: str = "value") -> DataFrame:
    r = _opened(df, column, _PRICE_JSON)
    return r.select(
        _text("chain", "base").alias("chain"),
        _text("asset_symbol").alias("symbol"),
        _text("asset_address").alias("asset_address"),
        F.coalesce("r.price_usd", F.lit(0.0)).alias("price_usd"),
        _text("source", "CHAINLINK").alias("source"),
        _millis(F.col("r.timestamp")).alias("timestamp"),
    )


def parse_transfers(df: DataFrame, column: str = "value") -> DataFrame:
    """Symbol, decimals, amount and usd stay NULL when absent.

    A missing id becomes `chain-tx-log`, the same on every replay.
    """
    r = _opened(df, column, _TRANSFER_JSON)
    chain, tx = _text("chain", "base"), _text("tx_hash")
    log = F.coalesce("r.log_index", F.lit(0))
    return r.select(
        F.coalesce("r.transfer_id", dash_key(chain, tx, log)).alias("transfer_id"),
        chain.alias("chain"),
        _text("token_address").alias("token_address"),
        F.col("r.token_symbol").alias("token_symbol"),
        F.col("r.token_decimals").alias("token_decimals"),
        _text("from_address").alias("from_address"),
        _text("to_address").alias("to_address"),
        _text("amount_raw", "0").alias("amount_raw"),
        F.col("r.amount").alias("amount"),
        F.col("r.amount_usd").alias("amount_usd"),
        F.coalesce("r.block_number", F.lit(0).cast("bigint")).alias("block_number"),
        tx.alias("tx_hash"),
        log.alias("log_index"),
        _millis(F.col("r.timestamp")).alias("timestamp"),
    )
