"""Dimension tables shipped with the product, and label lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The three seed tables.
TOKEN_METADATA = [
    ("0x833589fcd6edb6e08f4c7c32d4f71b54bda02913", "USDC", "USD Coin", 6, "usd-coin", True),
    ("0x4200000000000000000000000000000000000006", "WETH", "Wrapped Ether", 18, "weth", False),
    ("0x2ae3f1ec7f1f5012cfeab0185bfc7aa3cf0dec22", "cbETH", "Coinbase Wrapped Staked ETH", 18, "coinbase-wrapped-staked-eth", False),
    ("0x50c5725949a6f0c72e6c4a641f24049a917db0cb", "DAI", "Dai Stablecoin", 18, "dai", True),
    ("0xd9aaec86b65d86f6a7b5b1b0c42ffa531710b6ca", "USDbC", "USD Base Coin", 6, "bridged-usd-coin-base", True),
    ("0x940181a94a35a4569e4529a3cdfb74e38fd98631", "AERO", "Aerodrome Finance", 18, "aerodrome-finance", False),
    ("0xb6fe221fe9eef5aba221c348ba20a1bf5e73624c", "rETH", "Rocket Pool ETH", 18, "rocket-pool-eth", False),
    ("0x236aa50979d5f3de3bd1eeb40e81137f22ab794b", "tBTC", "tBTC v2", 18, "tbtc", False),
    ("0xc1cba3fcea344f92d9239c08c0568f6f2f0ee452", "wstETH", "Wrapped stETH", 18, "wrapped-steth", False),
]
PROTOCOL_CONTRACTS = [
    ("0xa238dd80c259a72e81d7e4664a9801593f98d1c5", "aave_v3", "pool", 3),
    ("0x2d5ee574e710219a521449679a4a7f2b43f046ad", "aave_v3", "oracle", 3),
    ("0x43955b0899Ab7232E3a454cf84AedD22Ad46FD33", "aave_v3", "data_provider", 3),
    ("0x5e76e98e0963ecdc6a065d1435f84065b7523f39", "aave_v3", "pool_addresses_provider", 3),
    ("0xe20fCBdBfFC4Dd138cE8b2E6FBb6CB49777ad64D", "aave_v3", "acl_manager", 3),
]
KNOWN_ADDRESSES = [
    ("0x3304e22ddaa22bcdc5fca2269b418046ae7b566a", "exchange", "coinbase", "manual", 1.0),
    ("0x28c6c06298d514db089934071355e5743bf21d60", "exchange", "binance", "manual", 1.0),
    ("0x21a31ee1afc51d94c2efccaa2092ad1028285549", "exchange", "binance", "manual", 1.0),
    ("0xdfd5293d8e347dfe59e90efd55b2956a1343963d", "exchange", "binance", "manual", 1.0),
    ("0x56eddb7aa87536c09ccc2793473599fd21a8b17f", "exchange", "binance", "manual", 1.0),
    ("0xa238dd80c259a72e81d7e4664a9801593f98d1c5", "protocol", "aave_v3_pool", "manual", 1.0),
    ("0x0000000000000000000000000000000000000000", "system", "null_address", "manual", 1.0),
]

SEEDS = {
    "token_metadata": (
        TOKEN_METADATA,
        "token_address string, token_symbol string, token_name string, token_decimals int, "
        "coingecko_id string, is_stablecoin boolean",
    ),
    "protocol_contracts": (
        PROTOCOL_CONTRACTS,
        "contract_address string, protocol_name string, contract_type string, version int",
    ),
    "known_addresses": (
        KNOWN_ADDRESSES,
        "address string, label_type string, label_name string, source string, confidence double",
    ),
}


def seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed table; `path` reads the same columns from a CSV file instead."""
    rows, ddl = SEEDS[name]
    if path:
        return spark.read.schema(ddl).option("header", True).csv(path)
    return spark.createDataFrame(rows, ddl)


def address_labels(labels: DataFrame, address: str) -> DataFrame:
    """Labels of one address; the address is matched in lower case."""
    return labels.where(F.lower("address") == address.lower()).select(
        "address", "label_type", "label_name", "source", "confidence"
    )


def label_addresses(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Attach label type and name to an address column.

    The label side carries no hint: the planner broadcasts it while its size
    is under the broadcast threshold and falls back to a sorted join above it.
    """
    tags = labels.select(
        F.lower("address").alias("_label_key"),
        F.col("label_type").alias(f"{column}_label_type"),
        F.col("label_name").alias(f"{column}_label_name"),
    )
    return df.join(tags, F.col(column) == F.col("_label_key"), "left").drop("_label_key")
