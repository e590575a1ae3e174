"""Whale addresses and their movements."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DEFAULTS, Settings
from tidemark.functions.values import day_of, moment

#: Weeks that movements are dealt to in turn, and parts of each week's addresses: the most files of a day for each direction.
WEEKS, PARTS = 16, 32


def position_whales(address_positions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Distinct (address, value): an account with two large positions appears twice."""
    return (
        address_positions.where(F.col("total_collateral_usd") >= settings.whale_position_usd)
        .select(
            F.col("user_address").alias("address"),
            F.lit("position_whale").alias("whale_type"),
            F.col("total_collateral_usd").cast("double").alias("whale_value_usd"),
        )
        .distinct()
    )


def transfer_whales(transfers: DataFrame, as_of: str | datetime, settings: Settings = DEFAULTS) -> DataFrame:
    first_day = day_of(as_of) - timedelta(days=settings.whale_window_days)
    return (
        transfers.where(F.col("event_date") >= F.lit(first_day))
        .groupBy(F.col("from_address").alias("address"))
        .agg(F.sum("amount_usd").alias("whale_value_usd"))
        .where(F.col("whale_value_usd") >= settings.whale_transfer_usd)
        .select("address", F.lit("transfer_whale").alias("whale_type"), "whale_value_usd")
    )


def whale_addresses(
    address_positions: DataFrame, transfers: DataFrame, as_of: str | datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per address. The type list is rebuilt from two counters, so the
    aggregate keeps two numbers per address instead of a growing array."""
    combined = position_whales(address_positions, settings).unionByName(
        transfer_whales(transfers, as_of, settings)
    )
    return (
        combined.groupBy("address")
        .agg(
            F.count_if(F.col("whale_type") == "position_whale").alias("_positions"),
            F.count_if(F.col("whale_type") == "transfer_whale").alias("_transfers"),
            F.max("whale_value_usd").alias("max_whale_value_usd"),
            F.count(F.lit(1)).alias("whale_type_count"),
        )
        .select(
            "address",
            F.concat(
                F.array_repeat(F.lit("position_whale"), F.col("_positions").cast("int")),
                F.array_repeat(F.lit("transfer_whale"), F.col("_transfers").cast("int")),
            ).alias("whale_types"),
            "max_whale_value_usd",
            "whale_type_count",
            (F.col("_positions") > 0).alias("is_position_whale"),
            (F.col("_transfers") > 0).alias("is_transfer_whale"),
            moment(as_of).alias("dbt_updated_at"),
        )
    )


def whale_movements(
    transfers: DataFrame,
    whales: DataFrame,
    as_of: str | datetime,
    settings: Settings = DEFAULTS,
    after: str | datetime | None = None,
) -> DataFrame:
    """Large transfers that touch a whale; the sending side names the direction.

    Transfers go to their senders once; both those of whales and the others are read from that one shuffle, and only the
    others go on to their receivers. Rows are dealt by week and part of the address, the list is copied to the weeks, and
    an address's transfers of a week meet its entry of the list in one window: they lie by weeks then, and a daily table
    is written from there without another shuffle. A busy sender is spread over its weeks. Hashes travel as bytes where
    that loses nothing. `after` is the high-water mark of an append run.
    """
    large = transfers.where(F.col("amount_usd") >= settings.whale_movement_min_usd)
    if after is not None:
        large = large.where(F.col("event_timestamp") > moment(after))
    shown = ["event_timestamp", "event_date", "token_address", "token_symbol", "from_address", "to_address", "amount", "amount_usd"]
    plain = F.col("tx_hash").rlike("^0x([0-9a-f]{2})+$")
    packed = [F.when(plain, F.unhex(F.substr("tx_hash", F.lit(3)))).alias("_bytes"), F.when(~plain, F.col("tx_hash")).alias("_text")]
    large = large.select("transfer_id", *shown, *packed, "block_number")
    listed = whales.where(F.col("address").isNotNull()).select("address", F.explode(F.sequence(F.lit(0), F.lit(WEEKS - 1))).alias("_week"), F.lit(True).alias("_listed"))
    week = F.pmod(F.floor(F.unix_date("event_date") / 7), F.lit(WEEKS))

    def told(rows: DataFrame, party: str) -> DataFrame:
        """Rows with `_whale`: whether the party is listed."""
        own = rows.withColumns({"_week": F.coalesce(week, F.lit(0)).cast("int"), "_listed": F.lit(False)})
        met = own.unionByName(listed.withColumnRenamed("address", party), allowMissingColumns=True)
        dealt = met.withColumn("_part", F.pmod(F.xxhash64(party), F.lit(PARTS))).repartition("_week", "_part")
        return dealt.withColumn("_whale", F.max("_listed").over(Window.partitionBy("_week", "_part", party))).where(~F.col("_listed"))

    by_sender = told(large, "from_address")
    sent = by_sender.where("_whale").select(*large.columns, F.lit("whale_out").alias("whale_direction"))
    received = told(by_sender.where(~F.col("_whale")).select(*large.columns), "to_address").where("_whale")
    moved = sent.unionByName(received.select(*large.columns, F.lit("whale_in").alias("whale_direction")))
    tx_hash = F.coalesce("_text", F.concat(F.lit("0x"), F.lower(F.hex("_bytes")))).alias("tx_hash")
    return moved.select(F.col("transfer_id").alias("movement_id"), *shown, "whale_direction", tx_hash, "block_number", moment(as_of).alias("dbt_updated_at"))
