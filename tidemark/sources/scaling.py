"""Contract integers to the units the models use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import scaled

# Decimals of the contract's fixed-point numbers.
USD_DIGITS = 8
HEALTH_DIGITS = 18
RATIO_DIGITS = 4
PRICE_DIGITS = 8


def scale_positions(accounts: DataFrame) -> DataFrame:
    """Account data to a position snapshot; accounts without collateral and debt are dropped."""
    return accounts.select(
        "chain",
        "protocol",
        F.lower("user_address").alias("user_address"),
        "block_number",
        F.col("total_collateral_base").cast("string").alias("total_collateral_eth"),
        F.col("total_debt_base").cast("string").alias("total_debt_eth"),
        F.col("available_borrows_base").cast("string").alias("available_borrow_eth"),
        scaled(F.col("total_collateral_base"), USD_DIGITS).alias("total_collateral_usd"),
        scaled(F.col("total_debt_base"), USD_DIGITS).alias("total_debt_usd"),
        scaled(F.col("health_factor"), HEALTH_DIGITS).alias("health_factor"),
        scaled(F.col("ltv"), RATIO_DIGITS).alias("ltv"),
        scaled(F.col("current_liquidation_threshold"), RATIO_DIGITS).alias("liquidation_threshold"),
        "timestamp",
    ).where(~((F.col("total_collateral_usd") == 0) & (F.col("total_debt_usd") == 0)))


def scale_prices(answers: DataFrame) -> DataFrame:
    """Oracle answers to a price record."""
    return answers.select(
        "chain",
        F.lower("asset_address").alias("asset_address"),
        "asset_symbol",
        scaled(F.col("answer"), PRICE_DIGITS).alias("price_usd"),
        F.lit("CHAINLINK").alias("source"),
        "block_number",
        "timestamp",
    )
