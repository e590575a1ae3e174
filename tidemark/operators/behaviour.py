"""What an address does: sliding-window features at each moment of activity, its hourly flow, and its time at risk.

Windows slide exactly, to the millisecond, and no task holds an address's history: rows are shuffled once, by address and
four weeks, and one pass over them in order (`sliding.slide`) keeps a week.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DAY_MS, DEFAULTS, HOUR_MS, Settings
from tidemark.functions.addresses import is_zero_address
from tidemark.functions.risk import risk_level
from tidemark.functions.values import from_millis, hour_of_millis, moment, moment_ms
from tidemark.operators.sliding import slide
from tidemark.operators.timeline import with_history

_MONEY = "decimal(38,8)"
WEEK_MS = 7 * DAY_MS
SPANS = {"1h": HOUR_MS, "24h": DAY_MS, "7d": WEEK_MS}
#: Stretches of time that an address is dealt by; rows of a stretch's last week lead in to the next one, too.
PART_MS = 4 * WEEK_MS
_OWNER = ["chain", "address"]


def activity(transfers: DataFrame, events: DataFrame) -> DataFrame:
    """(chain, address, at, usd, token, protocol): one row for each side of a transfer and one for each lending event.

    A transfer to oneself counts once; the zero address is nobody. Both inputs are staged.
    """
    sides = F.explode(F.array_distinct(F.array("from_address", "to_address")))
    moved = transfers.select(
        "chain", sides.alias("address"), F.unix_millis("event_timestamp").alias("at"), F.col("amount_usd").cast(_MONEY).alias("usd"),
        F.col("token_address").alias("token"), F.lit(None).cast("string").alias("protocol"),
    )
    lent = events.select(
        "chain", F.col("user_address").alias("address"), F.unix_millis("event_timestamp").alias("at"), F.col("amount_usd").cast(_MONEY).alias("usd"),
        F.nullif("asset_address", F.lit("")).alias("token"), "protocol",
    )
    rows = moved.unionByName(lent)
    return rows.where(F.col("at").isNotNull() & (F.col("address") != "") & ~is_zero_address(F.col("address")))


def behaviour_features(rows: DataFrame, as_of: str | datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Features of every address at every moment at which it did something, over the hour, day and week up to it.

    A span holds the times in (moment - span, moment]. `activity_hours` lists the hours of the day (UTC) with activity
    in the week. Likely bot: more than `bot_day_count` transactions in a day, or activity in `bot_hours` hours of the day;
    likely whale: a week's volume or a single amount of `whale_transfer_usd`. Null amounts count as 0.

    Rows are shuffled once; sums, distinct values and maxima come from one pass over the sorted rows, without a shuffle
    or a join of what they are made of.
    """
    amount = F.coalesce("usd", F.lit(0).cast(_MONEY)).alias("usd")
    own = F.floor(F.col("at") / PART_MS)
    parts = F.when(F.col("at") > (own + 1) * PART_MS - WEEK_MS, F.array(own, own + 1)).otherwise(F.array(own))
    copied = rows.select(*_OWNER, F.explode(parts).alias("part"), "at", amount, "token", "protocol")
    dealt = copied.repartition(*_OWNER, "part").withColumns({"own": F.floor(F.col("at") / PART_MS) == F.col("part"), "_hash": F.xxhash64(*_OWNER, "part")})
    # The hash leads: rows are told apart by a number first.
    ordered = dealt.sortWithinPartitions("_hash", *_OWNER, "part", "at").drop("_hash")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    sums = ", ".join(f"n_{span} bigint, usd_{span} {_MONEY}" for span in SPANS)
    schema = f"chain {types['chain']}, address {types['address']}, at bigint, {sums}, tokens bigint, protocols bigint, hours bigint, largest {_MONEY}"
    told = ordered.mapInArrow(lambda batches: slide(batches, _OWNER, SPANS), schema)
    active = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.getbit("hours", h) == 1)
    bot = (F.col("n_24h") >= settings.bot_day_count) | (F.bit_count("hours") >= settings.bot_hours)
    whale = (F.col("usd_7d") >= settings.whale_transfer_usd) | (F.col("largest") >= settings.whale_transfer_usd)
    return told.select(
        *_OWNER,
        from_millis(F.col("at") - WEEK_MS).alias("window_start"),
        from_millis(F.col("at")).alias("window_end"),
        *[F.col(f"n_{s}").alias(f"tx_count_{s}") for s in SPANS],
        *[F.col(f"usd_{s}").cast("double").alias(f"volume_usd_{s}") for s in SPANS],
        F.col("protocols").alias("unique_protocols_7d"),
        F.col("tokens").alias("unique_tokens_7d"),
        (F.col("usd_7d").cast("double") / F.col("n_7d")).alias("avg_tx_size_usd"),
        F.col("largest").cast("double").alias("max_tx_size_usd"),
        active.alias("activity_hours"),
        bot.cast("int").alias("is_likely_bot"),
        whale.cast("int").alias("is_likely_whale"),
        moment(as_of).alias("updated_at"),
    )


def address_flow_hourly(transfers: DataFrame, as_of: str | datetime) -> DataFrame:
    """Flow of each address by hour, with its top tokens and counterparty by value; ties go to the smaller address.

    Legs are shuffled once, dealt by hour and address: a busy address is spread over its hours. There, each leg is a row
    of its token and one of its counterparty; these are sorted once, summed by value and then by address and hour, both in
    that order, so that no task holds more than its sort does. A transfer to oneself flows both ways. The zero address has
    no row but is a counterparty.
    """
    own = F.struct("chain", "hour", "address").alias("own")
    # The hash leads: rows are told apart by a number first.
    group = ["_hash", "own"]
    side = lambda a, b, out: F.struct(F.col(a).alias("address"), F.col(b).alias("other"), F.lit(out).alias("out"))
    legs = transfers.select(
        "chain", hour_of_millis(F.unix_millis("event_timestamp")).alias("hour"), F.col("token_address").alias("token"), F.col("amount_usd").cast(_MONEY).alias("usd"),
        F.explode(F.array(side("to_address", "from_address", False), side("from_address", "to_address", True))).alias("s"),
    )
    legs = legs.select("chain", "hour", "token", "usd", "s.*").where(~is_zero_address(F.col("address")))
    dealt = legs.select(own, "out", "token", "other", "usd").withColumn("_hash", F.xxhash64("own")).repartition("_hash")
    met = lambda out, value: F.struct(out.alias("out"), F.col(value).alias("value"))
    kinds = F.array(met(F.col("out"), "token"), met(F.lit(None).cast("boolean"), "other"))
    rows = dealt.select(*group, "usd", F.explode(kinds).alias("k")).select(*group, "usd", "k.*")
    # The largest text of a group keeps its sums in sorted order, as texts have no place in a hash aggregate.
    rows = rows.groupBy(*group, "out", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("usd").cast(_MONEY).alias("usd"), F.max("value").alias("name"))
    top = lambda when: F.min_by("name", F.when(when, F.struct(-F.col("usd"), F.col("name"))))
    total = lambda name, when: F.coalesce(F.sum(F.when(when, F.col(name))), F.lit(0))
    in_, out, other = ~F.col("out"), F.col("out"), F.col("out").isNull()
    flow = rows.groupBy(*group).agg(
        total("n", in_).alias("inflow_count"),
        total("usd", in_).cast("double").alias("inflow_usd"),
        total("n", out).alias("outflow_count"),
        total("usd", out).cast("double").alias("outflow_usd"),
        (total("usd", in_) - total("usd", out)).cast("double").alias("net_flow_usd"),
        F.count(F.when(other, F.col("name"))).alias("unique_counterparties"),
        top(in_).alias("top_inflow_token"),
        top(out).alias("top_outflow_token"),
        top(other & F.col("name").isNotNull()).alias("top_counterparty"),
    )
    return flow.select("own.*", *flow.columns[len(group) :], moment(as_of).alias("updated_at"))


def time_in_risk(positions: DataFrame, as_of: str | datetime, period_ms: int = DAY_MS, settings: Settings = DEFAULTS, bucket_ms: int = DAY_MS) -> DataFrame:
    """How long each account was at each level in each period, and its safety margin.

    A position holds until the account's next one, the last until `as_of` (positions from then on don't count). Such
    intervals are clipped at the borders of the periods, so the seconds of an account's levels add up to the part of the
    period that its positions cover. At risk is every level but the safest. The margin is the health factor's distance
    from 1, at the end of the period and at its lowest. Rows without a time or health factor are skipped.
    """
    keys, end = ["chain", "protocol", "user_address"], moment_ms(as_of)
    order = ["timestamp", "block_number", "health_factor"]
    sound = positions.where(F.col("timestamp").isNotNull() & F.col("health_factor").isNotNull() & (F.col("timestamp") < end)).select(*keys, *order)
    state = F.struct(F.col("timestamp").alias("from_ms"), risk_level(F.col("health_factor"), settings).alias("level"), F.col("health_factor").alias("health"), F.col("block_number").alias("block"))
    rows = sound.withColumn("_state", state)
    ended = with_history(rows, keys, order, "_state", lambda prev, now: F.lit(None).cast("int"), bucket_ms)
    ended = ended.where("prev is not null").select(*keys, "prev.*", F.col("timestamp").alias("to_ms"))
    last = rows.groupBy(*keys).agg(F.max_by("_state", F.struct(*order)).alias("s")).select(*keys, "s.*", F.lit(end).alias("to_ms"))
    held = ended.unionByName(last)
    period = lambda ms: F.floor(ms / period_ms)
    # A position replaced at once covers no time but is the lowest or the last one of its period.
    until = F.greatest(F.col("from_ms"), F.col("to_ms") - 1)
    cut = held.withColumn("p", F.explode(F.sequence(period(F.col("from_ms")), period(until))))
    low, high = F.greatest(F.col("from_ms"), F.col("p") * period_ms), F.least(F.col("to_ms"), (F.col("p") + 1) * period_ms)
    cut = cut.withColumn("ms", high - low)
    recent = F.struct("from_ms", "block", "health")
    spent = lambda when: F.coalesce(F.sum(F.when(when, F.col("ms"))), F.lit(0)) / 1000
    return cut.groupBy(*keys, from_millis(F.col("p") * period_ms).alias("period_start")).agg(
        *[spent(F.col("level") == name).alias(f"{name.lower()}_seconds") for name in ("SAFE", "WARNING", "DANGER", "CRITICAL", "LIQUIDATABLE")],
        spent(F.col("level") != "SAFE").alias("time_in_risk_seconds"),
        spent(F.lit(True)).alias("covered_seconds"),
        F.max_by("level", recent).alias("risk_level"),
        F.max_by(F.col("health") - 1, recent).alias("safety_margin"),
        F.min(F.col("health") - 1).alias("lowest_margin"),
    )
