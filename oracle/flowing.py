"""Registered queries of streams that meet disordered, repeated and idle input, and streams beside tables.

Streams read files that the query itself writes from a fixture view, in the order in which they were written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import models
from oracle.registry import ENTRIES, _drained, register
from oracle.stored import folder
from oracle.views import raw, spark_view
from tidemark.operators import flows, pricing, risk
from tidemark.sources import schemas
from tidemark.sources.streams import StreamConfig, read_messages, stream_source
from tidemark.streaming import flow, jobs, sinks
from tidemark.streaming.jobs import JobOptions

MIDDLE_MS = 1_701_500_000_000


def in_turns(spark: SparkSession, parts: list[DataFrame], config: dict, ddl: str, start: Callable) -> str:
    """The output folder of a job that drains one part after the other, each written by as many tasks as it has.

    A part arrives when the one before it has been drained, and the job goes on under the same run: parts are batches, in
    this order, however many files they have.
    """
    path, out = folder(spark), folder(spark)
    options = JobOptions(run=f"queries-{uuid.uuid4().hex}", available_now=True)
    for part in parts:
        part.write.mode("append").parquet(path)
        start(stream_source(spark, StreamConfig(path=path, **config), ddl), out, options).awaitTermination()
    return out


# --- late transfers -------------------------------------------------------------


def _newest_first(s: SparkSession, d: str, start: Callable, columns: list[str] | None = None) -> str:
    rows = raw(s, d, "raw_transfers").select(*columns) if columns else raw(s, d, "raw_transfers")
    newer = F.col("timestamp") >= MIDDLE_MS
    return in_turns(s, [rows.where(newer), rows.where(~newer)], {}, schemas.TRANSFERS, start)


def _late(s: SparkSession, d: str) -> DataFrame:
    rows = sinks.read_batches(s, _newest_first(s, d, jobs.start_late_transfers))
    return rows.select("tx_hash", "log_index", "token_address", "timestamp", "window_end_ms", "late_by_ms")


register(
    "stream_late_transfers",
    _late,
    f"""select tx_hash, log_index, token_address, timestamp, closes window_end_ms, newest - closes late_by_ms
     from (select *, timestamp - timestamp % 3600000 + 3600000 closes, (select max(timestamp) from raw_transfers) newest from raw_transfers where timestamp < {MIDDLE_MS})
     where closes + 330000 <= newest""",
)


def _punctual(s: SparkSession, d: str) -> DataFrame:
    out = _newest_first(s, d, jobs.start_token_flow, flow.FLOW_INPUT)
    return sinks.read_upserts(s, out, ["chain", "token_address", "hour"], "updated_at").select("chain", "token_address", "hour", "transfer_count", "unique_senders_count")


register(
    "stream_punctual_flow",
    _punctual,
    f"""select chain, token_address, {models.HOUR} as hour, count(*) transfer_count, count(distinct from_address) unique_senders_count from raw_transfers
     where timestamp >= {MIDDLE_MS} or timestamp - timestamp % 3600000 + 3600000 + 330000 > (select max(timestamp) from raw_transfers) group by all""",
)

# --- distinct addresses over a day ----------------------------------------------


def _daily(s: SparkSession, d: str) -> DataFrame:
    """Daily flow from the transfers of the streamed hours; the distinct counts are compared with those of the raw transfers."""
    stream = raw(s, d, "raw_transfers", stream="lineitem")
    out = _drained(s, lambda o, options: jobs.start_token_flow(stream, o, options))
    day = F.to_date(F.timestamp_millis("timestamp")).alias("day")
    daily = flow.read_transfers(s, out).groupBy("chain", "token_address", day).agg(*flows.flow_measures())
    exact = raw(s, d, "raw_transfers").groupBy("chain", "token_address", day).agg(F.count_distinct("from_address").alias("senders"), F.count_distinct("to_address").alias("receivers"))
    near = lambda a, b: F.col(a) == F.col(b)
    return daily.join(exact, ["chain", "token_address", "day"]).select(
        "chain", "token_address", "day", "transfer_count", "total_volume", "max_transfer_size", "senders", "receivers",
        near("unique_senders_count", "senders").alias("senders_within"), near("unique_receivers_count", "receivers").alias("receivers_within"),
    )


register(
    "stream_token_flow_daily",
    _daily,
    f"""select chain, token_address, {models.DAY} as day, count(*) transfer_count, cast(sum(cast(coalesce(amount, 0e0) as decimal(38,18))) as decimal(38,18)) total_volume,
     max(cast(coalesce(amount, 0e0) as decimal(38,18))) max_transfer_size, count(distinct from_address) senders, count(distinct to_address) receivers,
     true senders_within, true receivers_within from raw_transfers group by all""",
)

# --- positions beside prices -----------------------------------------------------

_ASSET = "concat('0x', lpad(cast(900000 + block_number % 8 as string), 40, '0'))"


def _positions(s: SparkSession, d: str, stream: str | None = None) -> DataFrame:
    return raw(s, d, "raw_positions", stream).withColumn("asset_address", F.expr(_ASSET))


_FRESH = 3_600_000
models.CTES["asset_prices"] = "select chain, token_address, timestamp as at_ms, max(price_usd) usd from raw_prices where price_usd > 0 group by all"
_PRICED = f"""select p.chain, p.protocol, p.user_address, p.block_number, p.health_factor, p.asset_address, case when p.timestamp - q.at_ms <= {_FRESH} then q.usd end asset_price_usd,
 case when p.timestamp - q.at_ms <= {_FRESH} then q.at_ms end asset_price_ms
 from (select *, {_ASSET.replace("as string", "as varchar")} asset_address from raw_positions) p
 asof left join asset_prices q on q.chain = p.chain and q.token_address = p.asset_address and q.at_ms <= p.timestamp"""
_SHOWN = ["chain", "protocol", "user_address", "block_number", "health_factor", "asset_address", "asset_price_usd", "asset_price_ms"]

register("positions_beside_prices", lambda s, d: pricing.beside_prices(_positions(s, d), raw(s, d, "raw_prices"), _FRESH).select(*_SHOWN), _PRICED)


def _priced_stream(s: SparkSession, d: str) -> DataFrame:
    """Prices stream to their log first; the position stream then meets it, and its risk rows stay what they are."""
    options = JobOptions(run=f"queries-{uuid.uuid4().hex}", available_now=True)
    log = folder(s)
    jobs.start_prices(raw(s, d, "raw_prices", stream="lineitem"), log, options).awaitTermination()
    out = _drained(s, lambda o, opts: jobs.start_priced_positions(_positions(s, d, "orders"), log, o, opts, _FRESH))
    priced = sinks.read_batches(s, out)
    plain = [c for c in priced.columns if c not in ("asset_price_usd", "asset_price_ms")]
    level = risk.risk_metrics(priced.select(*plain)).select("chain", "protocol", "user_address", "block_number", "risk_level", "previous_risk_level")
    return priced.select(*_SHOWN).join(level, ["chain", "protocol", "user_address", "block_number"])


register(
    "stream_positions_beside_prices",
    _priced_stream,
    f"select a.*, r.risk_level, r.previous_risk_level from ({_PRICED}) a join risk_state r on r.chain = a.chain and r.protocol = a.protocol and r.user_address = a.user_address and r.block_number = a.block_number",
)

# --- watermarks of several topics --------------------------------------------------

_IDLE_MS = 1_705_000_000_000


def _topics(policy: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        """All topics but one; messages of `topic.error` end early, as if the topic had fallen idle."""
        messages = spark_view(s, d, "messages", stream="events")
        error = F.col("topic") == "topic.error"
        parts = [messages.where(~error), messages.where(error & (F.col("timestamp") < _IDLE_MS))]
        return sinks.read_batches(s, _drained(s, lambda o, options: jobs.start_topics(parts, "5 seconds", o, options, policy)))

    return run


models.CTES["topic_messages"] = f"select * from messages where topic <> 'topic.error' or timestamp < {_IDLE_MS}"
for _policy, _pick in (("min", "least"), ("max", "greatest")):
    register(
        f"stream_topics_{_policy}",
        _topics(_policy),
        f"""select topic, date_trunc('hour', make_timestamp(timestamp * 1000)) as hour, count(*) message_count from topic_messages
         where timestamp - timestamp % 3600000 + 3600000 <= (select {_pick}(max(timestamp) filter (topic = 'topic.error'), max(timestamp) filter (topic <> 'topic.error')) - 5000 from topic_messages) group by all""",
    )

# --- readers and restarts -----------------------------------------------------------

_ENVELOPE = ["topic", "partition", "offset", "key", "value", "timestamp", "processing_time"]


def _messages(s: SparkSession, d: str) -> DataFrame:
    return spark_view(s, d, "messages").withColumn("headers", F.create_map().cast("map<string,string>"))


def _stored_messages(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    _messages(s, d).write.parquet(path)
    return read_messages(s, path).select(*_ENVELOPE)


register("stored_messages", _stored_messages, ENTRIES["message_envelope"].body)


def _restarted(s: SparkSession, d: str) -> DataFrame:
    """A stream that stops after half of the files and goes on, under the same run, when the rest has arrived."""
    rows = _messages(s, d)
    early = F.col("timestamp") < _IDLE_MS
    out = in_turns(s, [rows.where(early), rows.where(~early)], {}, schemas.MESSAGES, jobs.start_prices)
    return sinks.read_batches(s, out).select(*_ENVELOPE)


register("stream_restart", _restarted, ENTRIES["message_envelope"].body)


def _repeated(s: SparkSession, d: str) -> DataFrame:
    """Every tenth message is delivered again within the window, from another file."""
    rows = _messages(s, d)
    again = rows.where("offset % 10 = 0").withColumn("processing_time", F.col("processing_time") + 1)
    out = in_turns(s, [rows, again], {}, schemas.MESSAGES, lambda stream, o, options: jobs.start_landing(stream, "k bigint", f"{o}/rows", f"{o}/dead", "100 days", options))
    return sinks.read_batches(s, f"{out}/rows")


register("stream_landing_repeats", _repeated, ENTRIES["stream_landing"].body)


def _from_offsets(s: SparkSession, d: str) -> DataFrame:
    """Two topics of a log that five share, two of their partitions from a given offset on, part after part."""
    rows = _messages(s, d)
    early = F.col("timestamp") < _IDLE_MS
    starts = '{"topic.view": {"0": 2000, "1": -2}, "topic.error": {"3": 5000}}'
    config = {"topics": ("topic.view", "topic.error"), "starting_offsets": starts}
    out = in_turns(s, [rows.where(early), rows.where(~early)], config, schemas.MESSAGES, jobs.start_prices)
    return sinks.read_batches(s, out).select(*_ENVELOPE)


register(
    "stream_from_offsets",
    _from_offsets,
    f"""select * from ({ENTRIES["message_envelope"].body}) where topic in ('topic.view', 'topic.error')
     and not (topic = 'topic.view' and partition = 0 and "offset" < 2000) and not (topic = 'topic.error' and partition = 3 and "offset" < 5000)""",
)
