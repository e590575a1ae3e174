"""Positions beside the price that was known of their asset at the time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DAY_MS
from tidemark.operators.timeline import latest

#: A price is known for this long.
FRESH_MS = 7 * DAY_MS


def beside_prices(positions: DataFrame, prices: DataFrame, fresh_ms: int = FRESH_MS) -> DataFrame:
    """Every position with `asset_price_usd` and `asset_price_ms`: its asset's newest price in the `fresh_ms` up to its time, or nulls.

    Positions and prices of an asset (chain, asset_address or token_address) run through one bucketed timeline, so an asset
    with a third of all rows is dealt to as many tasks as it has hours. Of several prices at one time the highest counts.
    Prices that are null or not above 0 don't count. Nothing else about a position changes; a position without chain,
    asset or time has no price.
    """
    timed = F.col("timestamp").isNotNull() & F.col("chain").isNotNull()
    placed = timed & F.col("asset_address").isNotNull()
    key = F.struct("chain", F.lower("asset_address").alias("asset")).alias("key")
    rows = positions.where(placed).select(key, F.col("timestamp").alias("at"), F.struct(*positions.columns).alias("position"), F.lit(None).cast("struct<ms:bigint,usd:double>").alias("price"))
    known = prices.where(timed & F.col("token_address").isNotNull() & (F.col("price_usd") > 0)).select(
        F.struct("chain", F.lower("token_address").alias("asset")).alias("key"),
        F.col("timestamp").alias("at"),
        F.lit(None).cast(rows.schema["position"].dataType).alias("position"),
        F.struct(F.col("timestamp").alias("ms"), F.col("price_usd").alias("usd")).alias("price"),
    )
    met = latest(rows.unionByName(known), ["key"], "at", "price").where("position is not null")
    fresh = F.col("at") - F.col("price.ms") <= fresh_ms
    priced = met.select("position.*", F.when(fresh, F.col("price.usd")).alias("asset_price_usd"), F.when(fresh, F.col("price.ms")).alias("asset_price_ms"))
    return priced.unionByName(positions.where(~F.coalesce(placed, F.lit(False))), allowMissingColumns=True)
