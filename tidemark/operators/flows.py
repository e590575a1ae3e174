"""Transfer aggregates: daily netflow per address and hourly flow per token."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DEFAULTS, Settings
from tidemark.functions.addresses import ZERO_ADDRESS
from tidemark.functions.values import dash_key, hour_of_millis, moment, sum_if

_NETFLOW_KEY = ["event_date", "address", "token_address"]
#: Parts of a day that netflow is dealt to: the most files of a day, and the least share of its rows in a task.
DAY_PARTS = 16
_OUT_ROW = "struct<token_symbol:string,out_n:bigint,out_amount:double,out_usd:double>"
_OUT_ROWS = f"array<{_OUT_ROW}>"


def transfer_legs(transfers: DataFrame) -> DataFrame:
    """One row per side of a transfer: `in` for the receiver, `out` for the sender.

    Burns have no receiving side and mints no sending side. The zero address
    is dropped here already, since no result row may carry it.
    """
    sides = F.array(
        F.struct(F.lit("in").alias("side"), F.col("to_address").alias("address")),
        F.struct(F.lit("out").alias("side"), F.col("from_address").alias("address")),
    )
    return (
        transfers.select(
            "event_date", "token_address", "token_symbol", "amount", "amount_usd", "transfer_type", F.inline(sides)
        )
        .where(F.when(F.col("side") == "in", F.col("transfer_type") != "burn").otherwise(F.col("transfer_type") != "mint"))
        .where(F.col("address") != ZERO_ADDRESS)
    )


def address_netflow_daily(transfers: DataFrame, as_of: str | datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Inflow and outflow per day, address and token, outer-joined.

    Both sides come from one scan and one shuffle: legs are dealt by day and part of the addresses, where they are
    summed per (key, symbol), paired and, in a daily table, written. A busy address is a few sums in the task of its
    part and day. A key normally has one symbol, and its summed row already is the joined row. Where a token was seen
    under several symbols, the outer join pairs the summed symbols of that key, a handful of rows in a window.
    """
    incoming, outgoing = F.col("side") == "in", F.col("side") == "out"

    def total(column: str, side: Column) -> Column:
        return F.sum(F.when(side, F.col(column)))

    part = F.pmod(F.xxhash64("address"), F.lit(DAY_PARTS)).alias("_part")
    legs = transfer_legs(transfers).select(*_NETFLOW_KEY, "token_symbol", "side", "amount", "amount_usd", part).repartition("event_date", "_part")
    summed = legs.groupBy("_part", *_NETFLOW_KEY, "token_symbol").agg(
        F.count_if(incoming).alias("in_n"),
        total("amount", incoming).alias("in_amount"),
        total("amount_usd", incoming).alias("in_usd"),
        F.count_if(outgoing).alias("out_n"),
        total("amount", outgoing).alias("out_amount"),
        total("amount_usd", outgoing).alias("out_usd"),
    )
    of_key = Window.partitionBy("_part", *_NETFLOW_KEY)
    own_out = F.struct("token_symbol", "out_n", "out_amount", "out_usd")
    sent = F.col("out_n") > 0
    keyed = summed.withColumns(
        {"_symbols": F.count(F.lit(1)).over(of_key), "_receives": F.max("in_n").over(of_key) > 0}
    ).withColumn("_outs", F.collect_list(F.when((F.col("_symbols") > 1) & sent, own_out)).over(of_key))
    # The outgoing rows each incoming row meets; one of them may be "none".
    partners = (
        F.when(F.col("_symbols") == 1, F.array(own_out))
        .when(F.col("in_n") == 0, F.when(F.col("_receives"), F.array().cast(_OUT_ROWS)).otherwise(F.array(own_out)))
        .when(F.size("_outs") == 0, F.array(F.lit(None).cast(_OUT_ROW)))
        .otherwise(F.col("_outs"))
    )
    rows = keyed.withColumn("o", F.explode(partners))

    def field(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return rows.select(
        dash_key("event_date", "address", "token_address").alias("netflow_key"),
        F.lit(settings.chain).alias("chain"),
        *_NETFLOW_KEY,
        F.when(F.col("in_n") > 0, F.col("token_symbol")).otherwise(F.col("o.token_symbol")).alias("token_symbol"),
        field("in_n").alias("inflow_count"),
        field("in_amount").alias("inflow_amount"),
        field("in_usd").alias("inflow_usd"),
        field("o.out_n").alias("outflow_count"),
        field("o.out_amount").alias("outflow_amount"),
        field("o.out_usd").alias("outflow_usd"),
        (field("in_amount") - field("o.out_amount")).alias("net_amount"),
        (field("in_usd") - field("o.out_usd")).alias("net_usd"),
        moment(as_of).alias("dbt_updated_at"),
    )


#: Base-2 logarithm of a sketch's registers: 4 KiB each; the standard error of a count is 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


FLOW_KEY = ["chain", "token_address", "hour"]


def flow_amount() -> Column:
    """A transfer's amount as an exact decimal; none counts as 0."""
    return F.coalesce(F.col("amount"), F.lit(0.0)).cast("decimal(38,18)")


def flow_measures(exact: bool = True) -> list[Column]:
    """Count, distinct senders and receivers, exact decimal volume and maximum.

    Where not `exact`, addresses go to sketches of bounded size that merge over hours; up to some hundred addresses a
    sketch lists them and its count is theirs.
    """
    amount = flow_amount()
    if exact:
        distinct = [F.count_distinct("from_address").alias("unique_senders_count"), F.count_distinct("to_address").alias("unique_receivers_count")]
    else:
        distinct = [F.hll_sketch_agg("from_address", SKETCH_BITS).alias("senders"), F.hll_sketch_agg("to_address", SKETCH_BITS).alias("receivers")]
    return [
        F.count(F.lit(1)).alias("transfer_count"),
        *distinct,
        F.sum(amount).alias("total_volume"),
        F.max(amount).alias("max_transfer_size"),
    ]


def average_size() -> Column:
    return F.when(
        F.col("transfer_count") > 0, F.col("total_volume").cast("double") / F.col("transfer_count")
    ).otherwise(F.lit(0.0))


def distinct_counts() -> list[Column]:
    """The counts that sketches of addresses estimate."""
    return [F.hll_sketch_estimate("senders").alias("unique_senders_count"), F.hll_sketch_estimate("receivers").alias("unique_receivers_count")]


def token_flow_daily(hourly: DataFrame) -> DataFrame:
    """Daily flow from stored hours: sums add up, sketches unite, so an address of many hours counts once."""
    united = hourly.groupBy("chain", "token_address", F.to_date("hour").alias("day")).agg(
        F.sum("transfer_count").alias("transfer_count"),
        F.hll_union_agg("senders").alias("senders"),
        F.hll_union_agg("receivers").alias("receivers"),
        F.sum("total_volume").cast("decimal(38,18)").alias("total_volume"),
        F.max("max_transfer_size").alias("max_transfer_size"),
    )
    return united.select("chain", "token_address", "day", "transfer_count", *distinct_counts(), "total_volume", average_size().alias("avg_transfer_size"), "max_transfer_size")


def token_flow_of(sides: DataFrame, key: list[str]) -> DataFrame:
    """Flow by `key` from rows of (hour, token, side, address): n, volume, largest, updated_at; each address counts once.

    Addresses meet before they are counted, so a key of many addresses is spread over many tasks.
    """
    seen = sides.groupBy(*key, "out", "address").agg(
        F.sum("n").alias("n"), F.sum("volume").cast("decimal(38,18)").alias("volume"), F.max("largest").alias("largest"), F.max("updated_at").alias("updated_at")
    )
    named, sent = F.col("address").isNotNull(), F.col("out")
    totals = seen.groupBy(*key).agg(
        F.sum(F.when(sent, F.col("n"))).alias("transfer_count"),
        F.count_if(sent & named).alias("unique_senders_count"),
        F.count_if(~sent & named).alias("unique_receivers_count"),
        F.sum(F.when(sent, F.col("volume"))).cast("decimal(38,18)").alias("total_volume"),
        F.max("largest").alias("max_transfer_size"),
        F.max("updated_at").alias("updated_at"),
    )
    return totals.select(
        *key, "transfer_count", "unique_senders_count", "unique_receivers_count", "total_volume", average_size().alias("avg_transfer_size"), "max_transfer_size", "updated_at"
    )


def token_flow_hourly(transfers: DataFrame, as_of: str | datetime) -> DataFrame:
    """Hourly flow per chain and token over transfer records."""
    return (
        transfers.where(F.col("timestamp").isNotNull())
        .groupBy("chain", "token_address", hour_of_millis(F.col("timestamp")).alias("hour"))
        .agg(*flow_measures())
        .select(
            "chain",
            "token_address",
            "hour",
            "transfer_count",
            "unique_senders_count",
            "unique_receivers_count",
            "total_volume",
            average_size().alias("avg_transfer_size"),
            "max_transfer_size",
            moment(as_of).alias("updated_at"),
        )
    )


def token_metrics_daily(
    transfers: DataFrame, prices: DataFrame, as_of: str | datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    """Daily transfer metrics per token with the day's open, high, low and close."""
    t, p = daily_transfers(transfers), daily_ohlc(prices)

    def price(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0.0)).alias(column)

    low, high = F.col("min_price_usd"), F.col("max_price_usd")
    return t.join(p, ["metrics_date", "token_address"], "left").select(
        dash_key("metrics_date", "token_address").alias("metrics_key"),
        F.lit(settings.chain).alias("chain"),
        "metrics_date",
        "token_address",
        "token_symbol",
        "transfer_count",
        "unique_senders",
        "unique_receivers",
        (F.col("unique_senders") + F.col("unique_receivers")).alias("total_active_addresses"),
        "total_volume",
        "total_volume_usd",
        "avg_transfer_usd",
        "max_transfer_usd",
        "mint_count",
        "mint_volume",
        "burn_count",
        "burn_volume",
        (F.col("mint_volume") - F.col("burn_volume")).alias("net_supply_change"),
        "regular_transfer_count",
        price("avg_price_usd"),
        price("min_price_usd"),
        price("max_price_usd"),
        price("open_price_usd"),
        price("close_price_usd"),
        F.when(low > 0, (high - low) / low).otherwise(F.lit(0.0)).alias("price_volatility"),
        moment(as_of).alias("dbt_updated_at"),
    )


def daily_transfers(transfers: DataFrame) -> DataFrame:
    kind = F.col("transfer_type")
    return transfers.groupBy(F.col("event_date").alias("metrics_date"), "token_address", "token_symbol").agg(
        F.count(F.lit(1)).alias("transfer_count"),
        F.count_distinct("from_address").alias("unique_senders"),
        F.count_distinct("to_address").alias("unique_receivers"),
        F.sum("amount").alias("total_volume"),
        F.sum("amount_usd").alias("total_volume_usd"),
        F.avg("amount_usd").alias("avg_transfer_usd"),
        F.max("amount_usd").alias("max_transfer_usd"),
        F.count_if(kind == "mint").alias("mint_count"),
        sum_if(F.col("amount"), kind == "mint").alias("mint_volume"),
        F.count_if(kind == "burn").alias("burn_count"),
        sum_if(F.col("amount"), kind == "burn").alias("burn_volume"),
        F.count_if(kind == "transfer").alias("regular_transfer_count"),
    )


def daily_ohlc(prices: DataFrame) -> DataFrame:
    """Open and close by time; prices with equal times are ordered by value."""
    moment_and_price = F.struct("price_timestamp", "price_usd")
    return (
        prices.groupBy(F.col("price_date").alias("metrics_date"), "token_address")
        .agg(
            F.avg("price_usd").alias("avg_price_usd"),
            F.min("price_usd").alias("min_price_usd"),
            F.max("price_usd").alias("max_price_usd"),
            F.min(moment_and_price).alias("_open"),
            F.max(moment_and_price).alias("_close"),
        )
        .select(
            "metrics_date",
            "token_address",
            "avg_price_usd",
            "min_price_usd",
            "max_price_usd",
            F.col("_open.price_usd").alias("open_price_usd"),
            F.col("_close.price_usd").alias("close_price_usd"),
        )
    )


def latest_prices(prices: DataFrame) -> DataFrame:
    """Last price per symbol; a table of its own that feeds no risk rule."""
    return (
        prices.groupBy("symbol")
        .agg(F.max(F.struct("timestamp", "price_usd", "source")).alias("_last"))
        .select("symbol", "_last.price_usd", "_last.timestamp", "_last.source")
    )
