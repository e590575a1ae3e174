"""Every registered query: the Spark callable and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import models, views
from oracle.models import ZERO, level, with_ctes
from oracle.views import AS_OF, NOW, TODAY, raw, raw_logs, rt_risk, spark_view
from tidemark.functions.addresses import (
    is_valid_address,
    is_zero_address,
    normalize_address,
    truncate_address,
)
from tidemark.functions.risk import risk_level, risk_rank, size_tier, utilization
from tidemark.operators import chain, checks, dq_windows, flows, lending, metrics, positions, risk, staging, timeline
from tidemark.operators import versions, whales
from tidemark.plans import marts, serving
from tidemark.session import checkpoint_root, use_utc
from tidemark.sources import logs, raw as raw_tables, records, scaling, seeds
from tidemark.streaming import jobs, sinks
from tidemark.streaming.jobs import JobOptions

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    body: str | None = None


ENTRIES: dict[str, Entry] = {}

# The transfers end on the morning of this day.
LAST_DAY = "2024-01-29 12:00:00"
LAST_NOW = f"timestamp '{LAST_DAY}'"
LAST_DATE = "date '2024-01-29'"


def register(name: str, run: Query, sql: str | None = None, doubles: tuple[str, ...] = (), places: int = 6) -> None:
    """Add a query. `doubles` names sums and averages of doubles: their last
    bits depend on the order of addition, so both sides report them rounded."""

    def rounded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        return df.withColumns({c: F.round(c, places) for c in doubles}) if doubles else df

    if name in ENTRIES:
        raise ValueError(f"duplicate query {name}")
    text = with_ctes(models.rounded(sql, doubles, places)) if sql else None
    ENTRIES[name] = Entry(rounded_run, text, sql)


# --- inputs -----------------------------------------------------------------


def blocks(spark, d):
    return raw(spark, d, "raw_blocks")


def transfers(spark, d, start=None):
    return staging.stg_transfers(raw(spark, d, "raw_transfers"), start=start)


def events(spark, d, start=None):
    return staging.stg_lending_events(raw(spark, d, "raw_lending_events"), start=start)


def staged_positions(spark, d):
    return staging.stg_positions(raw(spark, d, "raw_positions"))


def prices(spark, d):
    return staging.stg_prices(raw(spark, d, "raw_prices"))


def core_positions(spark, d):
    # Accounts without a real-time row take part in the left join as well.
    return positions.address_positions(raw(spark, d, "raw_positions"), rt_risk(spark, d, "block_number % 3 = 0"), AS_OF)


def netflow(spark, d):
    return flows.address_netflow_daily(transfers(spark, d), AS_OF)


def cdp(spark, d):
    return lending.cdp_metrics_daily(events(spark, d), staged_positions(spark, d), AS_OF)


def token_metrics(spark, d):
    return flows.token_metrics_daily(transfers(spark, d), prices(spark, d), AS_OF)


def whale_table(spark, d):
    return whales.whale_addresses(core_positions(spark, d), transfers(spark, d, "2023-12-31"), AS_OF)


def movements(spark, d):
    return whales.whale_movements(transfers(spark, d), whale_table(spark, d), AS_OF)


def kpis(spark, d):
    return marts.ecosystem_kpis(core_positions(spark, d), transfers(spark, d, "2024-01-29"), LAST_DAY)


def summary(spark, d):
    return marts.protocol_summary(core_positions(spark, d), events(spark, d, "2023-12-31"), AS_OF)


def alert_rows(spark, d):
    return risk.risk_alerts(raw(spark, d, "raw_positions"))


def window_metrics(spark, d, window_ms=60_000, slide_ms=30_000):
    return dq_windows.dq_window_metrics(spark_view(spark, d, "messages"), window_ms, slide_ms)


def joined_text(column: str):
    return F.array_join(column, ",").alias(column)


FLOW_SUMS = ("inflow_amount", "inflow_usd", "outflow_amount", "outflow_usd", "net_amount", "net_usd")
PIVOT_SUMS = tuple(f"{e}_volume_usd" for e in lending.PIVOTED_EVENTS)
CDP_SUMS = ("avg_health_factor", *PIVOT_SUMS, "net_supply_usd", "net_borrow_usd")
TOKEN_SUMS = ("total_volume", "total_volume_usd", "avg_transfer_usd", "mint_volume", "burn_volume")

# --- flagship ---------------------------------------------------------------

register(
    "risk_distribution",
    lambda s, d: marts.risk_distribution_long(core_positions(s, d)),
    """select risk_level, count(*) user_count, sum(total_collateral_usd) total_collateral_usd, sum(total_debt_usd) total_debt_usd,
     avg(health_factor) avg_health_factor, min(health_factor) min_health_factor from core_positions group by risk_level""",
    ("avg_health_factor",),
)

# --- sources ----------------------------------------------------------------


def _drift_blocks(s, d):
    """Table-definition spelling: tx_count, and a timestamp instead of milliseconds."""
    stored = blocks(s, d).withColumnRenamed("transaction_count", "tx_count")
    return raw_tables.conform(stored.withColumn("timestamp", F.timestamp_millis("timestamp")), views._RAW_DDL["raw_blocks"])


def _drift_events(s, d):
    stored = raw(s, d, "raw_lending_events").withColumnsRenamed(
        {"asset_address": "reserve_address", "liquidator_address": "liquidator"}
    )
    return raw_tables.conform(stored, views._RAW_DDL["raw_lending_events"])


def _drift_positions(s, d):
    stored = raw(s, d, "raw_positions").withColumnRenamed("liquidation_threshold", "current_liquidation_threshold")
    return raw_tables.conform(stored, views._RAW_DDL["raw_positions"])


def _drift_prices(s, d):
    stored = raw(s, d, "raw_prices").withColumnsRenamed(
        {"token_address": "asset_address", "token_symbol": "asset_symbol", "price_source": "source"}
    )
    iso = F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return raw_tables.conform(stored.withColumn("timestamp", iso), views._RAW_DDL["raw_prices"])


def _only(columns: str):
    return lambda run: lambda s, d: run(s, d).select(*[c.strip() for c in columns.split(",")])


_B = "block_number, block_hash, parent_hash, timestamp, transaction_count, gas_used, gas_limit, miner"
_E = ("chain, protocol, event_type, user_address, asset_address, asset_symbol, amount, amount_usd, liquidator_address, "
      "collateral_asset, debt_asset, block_number, tx_hash, log_index, timestamp")
_T = ("transfer_id, chain, token_address, token_symbol, token_decimals, from_address, to_address, amount_raw, amount, "
      "amount_usd, block_number, tx_hash, log_index, timestamp")
_P = ("chain, protocol, user_address, block_number, health_factor, total_collateral_usd, total_debt_usd, "
      "available_borrow_usd, ltv, liquidation_threshold, timestamp")
_M = "chain, token_address, token_symbol, price_usd, price_source, timestamp"
register("source_blocks", _only(_B)(_drift_blocks), f"select {_B.replace('gas_limit', 'cast(gas_limit as bigint) gas_limit')} from raw_blocks")
register("source_lending_events", _only(_E)(_drift_events), f"select {_E} from raw_lending_events")
register("source_transfers", _only(_T)(lambda s, d: raw(s, d, "raw_transfers")), f"select {_T} from raw_transfers")
register("source_positions", _only(_P)(_drift_positions), f"select {_P} from raw_positions")
register("source_prices", _only(_M)(_drift_prices), f"select {_M} from raw_prices")

_ADDRESSES = ", ".join(f"('{a}', '{t}', '{n}')" for a, t, n, _, _ in seeds.KNOWN_ADDRESSES)
_TOKENS = ", ".join(f"('{t[0]}', '{t[1]}', {t[3]})" for t in seeds.TOKEN_METADATA)
register(
    "seed_token_decimals",
    lambda s, d: transfers(s, d)
    .join(
        seeds.seed(s, "token_metadata").select(
            F.upper("token_symbol").alias("token_symbol"), F.col("token_decimals").alias("seed_decimals")
        ),
        "token_symbol",
        "left",
    )
    .groupBy("token_symbol", "seed_decimals")
    .agg(F.count(F.lit(1)).alias("transfer_count")),
    f"""select t.token_symbol, m.dec seed_decimals, count(*) transfer_count from stg_transfers t
     left join (values {_TOKENS}) m(addr, sym, dec) on t.token_symbol = upper(m.sym) group by all""",
)
register(
    "seed_address_labels",
    lambda s, d: seeds.label_addresses(
        transfers(s, d).select("transfer_id", "log_index", "from_address"), seeds.seed(s, "known_addresses"), "from_address"
    ).where("from_address_label_name is not null"),
    f"""select transfer_id, log_index, from_address, m.t from_address_label_type, m.n from_address_label_name
     from stg_transfers join (values {_ADDRESSES}) m(a, t, n) on from_address = m.a""",
)
register(
    "address_labels",
    lambda s, d: seeds.address_labels(
        transfers(s, d)
        .groupBy(F.col("to_address").alias("address"))
        .agg(F.max("token_symbol").alias("label_name"))
        .select("address", F.lit("receiver").alias("label_type"), "label_name", F.lit("derived").alias("source"), F.lit(1.0).alias("confidence")),
        "0x" + "7".zfill(40),
    ),
    f"""select to_address address, 'receiver' label_type, max(token_symbol) label_name, 'derived' source, 1e0 confidence
     from stg_transfers where to_address = '0x{"7".zfill(40)}' group by to_address""",
)
register(
    "parse_positions",
    lambda s, d: records.parse_positions(spark_view(s, d, "position_json")),
    f"""select 'base' chain, case when o_orderkey % 5 = 0 then 'aave_v3' else 'compound_v3' end protocol,
     {views._address('o_custkey')} user_address, o_orderkey + 1 block_number, '0' total_collateral_eth, '0' total_debt_eth, '0' available_borrow_eth,
     case when o_orderkey % 5 = 0 then 999e0 else 125e-2 end health_factor, 0e0 ltv,
     case when o_orderkey % 2 = 0 then 75e-2 when o_orderkey % 7 = 0 then 0e0 else 5e-1 end liquidation_threshold,
     cast(case when o_orderkey % 3 = 0 then 0e0 else o_custkey + 5e-1 end as decimal(38,8)) total_collateral_usd,
     cast(0 as decimal(38,8)) total_debt_usd, cast(0 as decimal(38,8)) available_borrow_usd,
     case when o_orderkey % 11 = 0 then null else 1698796800000 + o_orderkey * 2000 end as timestamp from position_json""",
)
register(
    "parse_prices",
    lambda s, d: records.parse_prices(spark_view(s, d, "price_json")),
    f"""select 'base' chain, concat('S', cast(l_partkey % 8 as varchar)) symbol, {views._address('900000 + l_partkey % 8')} asset_address,
     case when l_linenumber = 1 then 0e0 else l_suppkey + 25e-2 end price_usd, case when l_linenumber = 2 then 'OTHER' else 'CHAINLINK' end source,
     1698796800000 + l_orderkey * 1000 as timestamp from price_json""",
)
register(
    "parse_transfers",
    lambda s, d: records.parse_transfers(spark_view(s, d, "transfer_json")),
    f"""select case when l_linenumber = 2 then concat('base-', {views._hash('l_orderkey')}, '-2') else concat(cast(l_orderkey as varchar), '-', cast(l_partkey as varchar)) end transfer_id,
     'base' chain, '' token_address, case when l_linenumber = 4 then null else 'USDC' end token_symbol, case when l_linenumber = 4 then null else 6 end token_decimals,
     '' from_address, '' to_address, case when l_linenumber = 5 then '0' else '115792089237316195423570985008687907853269984665640564039457584007913129639935' end amount_raw,
     case when l_linenumber = 3 then null else l_suppkey + 5e-1 end amount, cast(null as double) amount_usd, cast(0 as bigint) block_number,
     {views._hash('l_orderkey')} tx_hash, l_linenumber log_index, 1698796800000 + l_orderkey * 1000 as timestamp from transfer_json""",
)
_MSG = "topic, partition, offset, key, value, timestamp, processing_time"
register("message_envelope", _only(_MSG)(lambda s, d: spark_view(s, d, "messages")), f"select {_MSG.replace('offset', '"offset"')} from messages")
register(
    "decode_transfers",
    lambda s, d: logs.decode_transfers(raw_logs(s, d, "raw_transfer_logs")),
    """select concat(tx_hash, '-', cast(log_index as varchar)) transfer_id, 'base' chain, token_address,
     concat('0x', lpad(lower(hex(cast(substring(from_address, 3, 40) as bigint))), 40, '0')) from_address,
     concat('0x', lpad(lower(hex(cast(substring(to_address, 3, 40) as bigint))), 40, '0')) to_address,
     case (block_number - 1) % 50 """
    + " ".join(f"when {i} then '{n}'" for i, n in enumerate(views.WIDE))
    + """ else amount_raw end amount_raw, block_number, tx_hash, log_index, timestamp from raw_transfers""",
)
_W = views._address
register(
    "decode_lending_events",
    lambda s, d: logs.decode_lending_events(raw_logs(s, d, "raw_lending_logs")),
    f"""select concat({views._hash('event_id')}, '-', cast(event_id % 7 as varchar)) event_id, kind event_type, 'aave_v3' protocol, 'base' chain,
     '0x' || lpad(lower(hex(case when kind in ('WITHDRAW', 'REPAY') then 800000 + user_id when kind = 'LIQUIDATION' then 600000 + event_id else 500000 + user_id end)), 40, '0') user_address,
     '0x' || lpad(lower(hex(case when kind in ('LIQUIDATION', 'FLASH_LOAN') then 800000 + user_id else 900000 + user_id % 8 end)), 40, '0') asset_address,
     cast(case when kind in ('WITHDRAW', 'REPAY') then 500000 + user_id else cast(round(value * 1e6) as bigint) end as varchar) amount,
     case when kind in ('SUPPLY', 'BORROW') then '0x' || lpad(lower(hex(800000 + user_id)), 40, '0') end on_behalf_of,
     case when kind = 'LIQUIDATION' then '0x' || lpad(lower(hex(400000 + event_id)), 40, '0') end liquidator_address,
     case when kind = 'LIQUIDATION' then '0x' || lpad(lower(hex(900000 + user_id % 8)), 40, '0') end collateral_asset,
     case when kind = 'LIQUIDATION' then cast(500000 + user_id as varchar) end debt_to_cover,
     block_number, tx_hash, log_index, timestamp
     from (select *, case when event_id % 100 = 7 then 'FLASH_LOAN' when event_type = 'view' then 'SUPPLY' when event_type = 'click' then 'WITHDRAW'
      when event_type = 'purchase' then 'BORROW' when event_type = 'signup' then 'REPAY' else 'LIQUIDATION' end kind,
      event_id + 1 block_number, {views._hash('event_id')} tx_hash, cast(event_id % 7 as int) log_index, (epoch_us(ts) // 1000) as timestamp from events)""",
)
register(
    "scale_positions",
    lambda s, d: scaling.scale_positions(
        views.table(s, d, "orders").select(
            F.lit("base").alias("chain"),
            F.lit("aave_v3").alias("protocol"),
            F.expr(f"upper({_W('o_custkey')})").alias("user_address"),
            F.expr("o_orderkey + 1").alias("block_number"),
            F.expr("case when o_orderkey % 4 = 0 then 0 else cast(round(o_totalprice * 1e2) as bigint) * 1000000 end").alias("total_collateral_base"),
            F.expr("case when o_orderkey % 6 = 0 then 0 else o_custkey * 100000000 end").alias("total_debt_base"),
            F.expr("o_orderkey * 7").alias("available_borrows_base"),
            F.expr("cast(o_orderkey as decimal(20,0)) * 100000000000000").alias("health_factor"),
            F.expr("o_custkey % 10000").alias("ltv"),
            F.expr("o_orderkey % 10000").alias("current_liquidation_threshold"),
            F.expr("o_orderkey * 1000").alias("timestamp"),
        )
    ),
    f"""select * from (select 'base' chain, 'aave_v3' protocol, lower({_W('o_custkey')}) user_address, o_orderkey + 1 block_number,
     cast(c as varchar) total_collateral_eth, cast(t as varchar) total_debt_eth, cast(o_orderkey * 7 as varchar) available_borrow_eth,
     cast(c as double) / 1e8 total_collateral_usd, cast(t as double) / 1e8 total_debt_usd, cast(o_orderkey * 100000000000000 as double) / 1e18 health_factor,
     cast(o_custkey % 10000 as double) / 1e4 ltv, cast(o_orderkey % 10000 as double) / 1e4 liquidation_threshold, o_orderkey * 1000 as timestamp
     from (select *, case when o_orderkey % 4 = 0 then 0 else cast(round(o_totalprice * 1e2) as bigint) * 1000000 end c,
      case when o_orderkey % 6 = 0 then 0 else o_custkey * 100000000 end t from orders)) where not (total_collateral_usd = 0 and total_debt_usd = 0)""",
)
register(
    "scale_prices",
    lambda s, d: scaling.scale_prices(
        views.table(s, d, "lineitem").select(
            F.lit("base").alias("chain"),
            F.expr(f"upper({_W('l_partkey')})").alias("asset_address"),
            F.lit("WETH").alias("asset_symbol"),
            F.expr("cast(round(l_extendedprice * 1e2) as bigint) * 1000000").alias("answer"),
            F.expr("l_orderkey").alias("block_number"),
            F.expr("l_orderkey * 1000").alias("timestamp"),
        )
    ),
    f"""select 'base' chain, lower({_W('l_partkey')}) asset_address, 'WETH' asset_symbol,
     cast(cast(round(l_extendedprice * 1e2) as bigint) * 1000000 as double) / 1e8 price_usd, 'CHAINLINK' source, l_orderkey block_number,
     l_orderkey * 1000 as timestamp from lineitem""",
)

# --- staging and predicates -------------------------------------------------

register("stg_blocks", lambda s, d: staging.stg_blocks(blocks(s, d)), "select * from stg_blocks")
register("stg_lending_events", events, "select * from stg_lending_events")
register("stg_positions", staged_positions, "select * from stg_positions")
register("stg_transfers", transfers, "select * from stg_transfers")
register("stg_prices", prices, "select * from stg_prices")
register(
    "risk_levels",
    lambda s, d: raw(s, d, "raw_positions").select(
        "user_address",
        "block_number",
        risk_level(F.col("health_factor")).alias("risk_level"),
        risk_rank(risk_level(F.col("health_factor"))).alias("risk_rank"),
        size_tier(F.col("total_collateral_usd")).alias("size_tier"),
        utilization(F.col("total_debt_usd"), F.col("total_collateral_usd")).alias("utilization_rate"),
    ),
    f"""select user_address, block_number, {level('health_factor')} risk_level,
     cast({models.rank(level('health_factor'))} as int) risk_rank,
     case when total_collateral_usd >= 1000000 then 'whale' when total_collateral_usd >= 100000 then 'large' when total_collateral_usd >= 10000 then 'medium' else 'small' end size_tier,
     case when total_collateral_usd > 0 then cast(total_debt_usd as double) / cast(total_collateral_usd as double) else 0e0 end utilization_rate
     from raw_positions""",
)


def _addresses(s, d):
    c = F.when(F.col("log_index") == 1, F.upper("from_address")).when(F.col("log_index") == 2, F.substring("to_address", 1, 9)).otherwise(F.col("to_address"))
    return raw(s, d, "raw_transfers").select("block_number", "log_index", c.alias("a")).select(
        "block_number",
        "log_index",
        normalize_address(F.col("a")).alias("normal"),
        is_zero_address(F.col("a")).alias("zero"),
        is_valid_address(F.col("a")).alias("strict_valid"),
        is_valid_address(F.col("a"), strict=False).alias("loose_valid"),
        truncate_address(F.col("a")).alias("short_guarded"),
        truncate_address(F.col("a"), guard=False).alias("short_always"),
    )


register(
    "address_functions",
    _addresses,
    f"""select block_number, log_index, lower(a) normal, lower(a) = {ZERO} zero, regexp_full_match(a, '0x[a-fA-F0-9]{{40}}') strict_valid,
     length(a) = 42 and substring(a, 1, 2) = '0x' loose_valid,
     case when length(a) < 13 then a else concat(substring(a, 1, 6), '...', right(a, 4)) end short_guarded,
     concat(substring(a, 1, 6), '...', right(a, 4)) short_always
     from (select block_number, log_index, case when log_index = 1 then upper(from_address) when log_index = 2 then substring(to_address, 1, 9) else to_address end a from raw_transfers)""",
)
register(
    "confirmed_blocks",
    lambda s, d: chain.confirmed(blocks(s, d)).select("block_number", "block_hash"),
    "select block_number, block_hash from raw_blocks where block_number <= greatest((select max(block_number) from raw_blocks) - 6, 0)",
)
register(
    "block_slice",
    lambda s, d: chain.block_slice(blocks(s, d), 101, 1100).select("block_number", "block_hash"),
    "select block_number, block_hash from raw_blocks where block_number between 101 and 1100",
)

# --- core tables ------------------------------------------------------------

register("core_address_positions", core_positions, "select * from core_positions")
register(
    "latest_positions",
    lambda s, d: positions.latest_positions(raw(s, d, "raw_positions")).select("chain", "protocol", "user_address", "block_number", "health_factor", "timestamp"),
    "select chain, protocol, user_address, block_number, health_factor, timestamp from newest_positions",
)
register("core_address_netflow_daily", netflow, "select * from netflow", FLOW_SUMS)
register("core_cdp_metrics_daily", cdp, "select * from cdp_metrics", CDP_SUMS)
register("core_token_metrics_daily", token_metrics, "select * from token_metrics", (*TOKEN_SUMS, "net_supply_change", "avg_price_usd"))
register("daily_events", lambda s, d: lending.daily_events(events(s, d)), "select * from events_by_day", ("volume_usd", "avg_amount_usd"))
register("event_pivot", lambda s, d: lending.event_pivot(lending.daily_events(events(s, d))), "select * from event_pivot", PIVOT_SUMS)
register("daily_positions", lambda s, d: lending.daily_positions(staged_positions(s, d)), "select * from positions_by_day", ("avg_health_factor",))
register(
    "daily_positions_latest",
    lambda s, d: lending.daily_positions(staged_positions(s, d), latest_only=True),
    """select position_date metrics_date, protocol, count(distinct user_address) total_users, sum(total_collateral_usd) total_tvl_usd, sum(total_debt_usd) total_debt_usd,
     avg(health_factor) avg_health_factor, min(health_factor) min_health_factor, count(*) filter (health_factor < 1e0) critical_positions, count(*) filter (health_factor < 1e0) liquidatable_positions
     from (select *, row_number() over (partition by position_date, chain, protocol, user_address order by block_number desc) rn from stg_positions) where rn = 1 group by position_date, protocol""",
    ("avg_health_factor",),
)
register("daily_transfers", lambda s, d: flows.daily_transfers(transfers(s, d)), "select * from transfers_by_day", TOKEN_SUMS)
register("daily_ohlc", lambda s, d: flows.daily_ohlc(prices(s, d)), "select * from daily_ohlc", ("avg_price_usd",))
register(
    "core_whale_addresses",
    lambda s, d: whale_table(s, d).withColumn("whale_types", F.array_join("whale_types", ",")),
    "select * replace (array_to_string(whale_types, ',') as whale_types) from whales",
    ("max_whale_value_usd",),
)
register(
    "whale_sources",
    lambda s, d: whales.position_whales(core_positions(s, d)).unionByName(whales.transfer_whales(transfers(s, d), AS_OF)),
    "select * from whale_values",
    ("whale_value_usd",),
)
register(
    "latest_version",
    lambda s, d: versions.latest_version(rt_risk(s, d), positions.ACCOUNT, "version"),
    "select * from rt_latest",
)
register(
    "sum_merge",
    lambda s, d: versions.sum_merge(transfers(s, d).withColumn("usd", F.col("amount_usd").cast("decimal(18,2)")), ["token_address", "event_hour"], ["usd", "log_index"]),
    "select token_address, event_hour, cast(sum(cast(amount_usd as decimal(18,2))) as decimal(28,2)) usd, cast(sum(log_index) as bigint) log_index from stg_transfers group by all",
)
register(
    "high_water",
    lambda s, d: transfers(s, d).where(
        F.col("event_timestamp") > transfers(s, d).where(F.col("event_date") < "2024-01-15").agg(F.max("event_timestamp")).scalar()
    ).select("transfer_id", "event_timestamp", "log_index"),
    """select transfer_id, event_timestamp, log_index from stg_transfers
     where event_timestamp > (select max(event_timestamp) from stg_transfers where event_date < date '2024-01-15')""",
)

# --- marts ------------------------------------------------------------------

_SUMMARY_SUMS = ("avg_health_factor", "volume_7d", "supply_volume_7d", "borrow_volume_7d", "volume_30d")
register("mart_protocol_summary", summary, "select * from protocol_summary", _SUMMARY_SUMS)
register("mart_ecosystem_kpis", kpis, "select * from kpis", ("avg_health_factor", "volume_24h"))
register(
    "mart_ecosystem_kpis_last_day",
    lambda s, d: marts.ecosystem_kpis(core_positions(s, d), transfers(s, d, "2024-01-29"), LAST_DAY),
    models.CTES["kpis"].replace(NOW, LAST_NOW).replace(TODAY, "date '2024-01-29'"),
    ("avg_health_factor", "volume_24h"),
)
register(
    "token_breakdown_daily",
    lambda s, d: marts.token_breakdown_daily(transfers(s, d, "2023-12-31"), AS_OF),
    f"""select event_date, count(distinct from_address) unique_senders, count(distinct to_address) unique_receivers, count(*) transfer_count, sum(amount_usd) volume_usd,
     count(*) filter (token_symbol = 'USDC') usdc_transfers, coalesce(sum(amount_usd) filter (token_symbol = 'USDC'), 0e0) usdc_volume,
     count(*) filter (token_symbol = 'WETH') weth_transfers, coalesce(sum(amount_usd) filter (token_symbol = 'WETH'), 0e0) weth_volume
     from stg_transfers where event_date >= {TODAY} - 30 group by event_date""",
    ("volume_usd", "usdc_volume", "weth_volume"),
)
register(
    "event_volume_daily",
    lambda s, d: marts.event_volume_daily(events(s, d, "2023-12-31"), AS_OF),
    f"select event_date, event_type, count(*) event_count, sum(amount_usd) volume_usd from stg_lending_events where event_date >= {TODAY} - 30 group by event_date, event_type",
    ("volume_usd",),
)
register(
    "mart_risk_dashboard",
    lambda s, d: marts.risk_dashboard(core_positions(s, d), AS_OF),
    f"""select section, metric_name, metric_value, {NOW} snapshot_time from (
     select 'summary' section, 'total_users' metric_name, cast(count(*) as varchar) metric_value from core_positions
     union all select 'summary', 'total_tvl_usd', cast(cast(sum(total_collateral_usd) as decimal(38,2)) as varchar) from core_positions
     union all select 'summary', 'total_debt_usd', cast(cast(sum(total_debt_usd) as decimal(38,2)) as varchar) from core_positions
     union all select 'summary', 'avg_health_factor', cast(cast(avg(health_factor) as decimal(18,6)) as varchar) from core_positions
     union all select 'risk_distribution', risk_level, cast(count(*) as varchar) from core_positions group by risk_level
     union all select 'size_distribution', position_size_tier, cast(count(*) as varchar) from core_positions group by position_size_tier)""",
)
register(
    "size_distribution",
    lambda s, d: marts.size_distribution(core_positions(s, d)),
    "select position_size_tier, count(*) user_count, sum(total_collateral_usd) total_collateral_usd, avg(health_factor) avg_health_factor from core_positions group by position_size_tier",
    ("avg_health_factor",),
)
register("mart_whale_movements", movements, "select * from movements")

# --- serving ----------------------------------------------------------------

_USER = "0x" + "7".zfill(40)
_ORDERED_USER = "0x" + "0".zfill(40)
_RISK_COLS = """chain, protocol, user_address address, health_factor, risk_level, cast(total_collateral_usd as varchar) total_collateral_usd,
 cast(total_debt_usd as varchar) total_debt_usd, cast(available_borrow_usd as varchar) available_borrow_usd, ltv, liquidation_threshold, updated_at"""
_ONE_RISK = f"""select {_RISK_COLS}, case when total_collateral_usd >= 1000000 then 'whale' when total_collateral_usd >= 100000 then 'large' when total_collateral_usd >= 10000 then 'medium' else 'small' end position_size_tier,
 case when total_collateral_usd > 0 then cast(total_debt_usd as double) / cast(total_collateral_usd as double) else 0e0 end utilization_rate
 from rt_latest where user_address = '{_USER}' order by updated_at desc, version desc limit 1"""
register("address_risk", lambda s, d: serving.address_risk(rt_risk(s, d), _USER.upper().replace("0X", "0x")), _ONE_RISK)
register("address_positions", lambda s, d: serving.address_positions_of(rt_risk(s, d), _USER), _ONE_RISK)
register(
    "high_risk",
    lambda s, d: serving.high_risk(rt_risk(s, d), "LIQUIDATABLE", 500, 5000),
    f"""select {_RISK_COLS} from (select * from rt_latest where risk_level = 'LIQUIDATABLE' and total_collateral_usd >= 5000
     order by health_factor, user_address, protocol, chain limit 500)""",
)
register(
    "risk_distribution_wide",
    lambda s, d: serving.current_risk_distribution(rt_risk(s, d)),
    "select " + ", ".join(f"count(*) filter (risk_level = '{v}') {v.lower()}" for v in ("SAFE", "WARNING", "DANGER", "CRITICAL", "LIQUIDATABLE")) + " from rt_latest",
)
_FLOW = f"""select event_date, sum(inflow_usd) i, sum(outflow_usd) o, sum(net_usd) n from netflow
 where address = '{_USER}' and event_date >= {TODAY} - 365 group by event_date"""
register(
    "address_flow",
    lambda s, d: serving.address_flow(netflow(s, d), _USER, AS_OF, 365),
    f"select cast(event_date as varchar) as date, printf('%.2f', i) inflow_usd, printf('%.2f', o) outflow_usd, printf('%.2f', n) net_usd from ({_FLOW})",
)
register(
    "address_flow_totals",
    lambda s, d: serving.address_flow_totals(netflow(s, d), _USER, AS_OF, 365),
    f"""select '{_USER}' address, 365 period_days, printf('%.2f', coalesce(sum(i), 0e0)) total_inflow_usd, printf('%.2f', coalesce(sum(o), 0e0)) total_outflow_usd,
     printf('%.2f', coalesce(sum(i), 0e0) - coalesce(sum(o), 0e0)) net_flow_usd from ({_FLOW})""",
)
_TOKEN = "0x" + "900001".zfill(40)
register(
    "address_flow_by_token",
    lambda s, d: serving.address_flow(netflow(s, d), _USER, AS_OF, 60, _TOKEN),
    f"""select cast(event_date as varchar) as date, printf('%.2f', sum(inflow_usd)) inflow_usd, printf('%.2f', sum(outflow_usd)) outflow_usd, printf('%.2f', sum(net_usd)) net_usd
     from netflow where address = '{_USER}' and token_address = '{_TOKEN}' and event_date >= {TODAY} - 60 group by event_date""",
)


def _plain(column: str, places: int) -> str:
    return f"regexp_replace(regexp_replace(cast(cast({column} as decimal(38,{places})) as varchar), '0+$', ''), '\\.$', '')"


_MOVE_ORDER = "order by event_timestamp desc, tx_hash, movement_id, amount_usd desc, from_address, to_address"
register(
    "whale_movements",
    lambda s, d: serving.whale_movements_list(movements(s, d), AS_OF, 168, 20_000, "out"),
    f"""select event_timestamp as timestamp, from_address, to_address, token_symbol, amount, amount_usd, whale_direction direction, tx_hash from (
     select * from movements where event_timestamp >= {NOW} - interval 168 hours and amount_usd >= 20000 and whale_direction = 'whale_out' {_MOVE_ORDER} limit 1000)"""
    .replace("amount, amount_usd", f"{_plain('amount', 12)} amount, {_plain('amount_usd', 2)} amount_usd", 1),
)
register(
    "whale_movements_totals",
    lambda s, d: serving.whale_movements_totals(movements(s, d), AS_OF, 168, 20_000, "all"),
    f"""select 168 period_hours, count(*) total_movements, printf('%.2f', coalesce(sum(amount_usd), 0e0)) total_volume_usd from (
     select * from movements where event_timestamp >= {NOW} - interval 168 hours and amount_usd >= 20000)""",
)
register(
    "whale_list",
    lambda s, d: serving.whale_list(whale_table(s, d), 50).withColumn("whale_types", F.array_join("whale_types", ",")),
    """select address, array_to_string(whale_types, ',') whale_types, max_whale_value_usd, is_position_whale, is_transfer_whale
     from whales order by max_whale_value_usd desc, address limit 50""",
    ("max_whale_value_usd",),
)
register(
    "ecosystem_stats",
    lambda s, d: serving.ecosystem_stats(kpis(s, d), rt_risk(s, d)),
    """select snapshot_time, cast(total_tvl as varchar) total_tvl_usd, cast(total_debt as varchar) total_debt_usd, unique_users total_users, active_users_24h,
     printf('%.2f', volume_24h) volume_24h_usd, avg_health_factor, at_risk_positions, r.* from kpis, (select """
    + ", ".join(f"count(*) filter (risk_level = '{v}') {v.lower()}" for v in ("SAFE", "WARNING", "DANGER", "CRITICAL", "LIQUIDATABLE"))
    + " from rt_latest) r",
    ("avg_health_factor",),
)
register(
    "tvl_history",
    lambda s, d: serving.tvl_history(cdp(s, d), AS_OF, 90),
    f"""select metrics_date, sum(total_tvl_usd) total_tvl, sum(total_debt_usd) total_debt, cast(sum(total_users) as bigint) total_users
     from cdp_metrics where metrics_date >= {TODAY} - 90 group by metrics_date""",
)
register(
    "hourly_volume",
    lambda s, d: serving.hourly_volume(transfers(s, d, "2024-01-28 12:00:00"), LAST_DAY),
    f"""select event_hour as hour, sum(amount_usd) volume_usd, count(*) transfer_count, count(distinct from_address) + count(distinct to_address) unique_addresses
     from stg_transfers where event_timestamp >= {LAST_NOW} - interval 24 hours group by event_hour""",
    ("volume_usd",),
)
register(
    "token_distribution",
    lambda s, d: serving.token_distribution(transfers(s, d, "2024-01-28 12:00:00"), LAST_DAY),
    f"""select token_symbol, sum(amount_usd) total_volume, count(*) transfer_count, count(distinct from_address) unique_senders
     from stg_transfers where event_timestamp >= {LAST_NOW} - interval 24 hours group by token_symbol order by total_volume desc, token_symbol limit 10""",
    ("total_volume",),
)
register(
    "risk_summary",
    lambda s, d: serving.risk_summary(core_positions(s, d)),
    "select risk_level, count(*) user_count, sum(total_collateral_usd) total_collateral, sum(total_debt_usd) total_debt, avg(health_factor) avg_health_factor from core_positions group by risk_level",
    ("avg_health_factor",),
)
register(
    "high_risk_positions",
    lambda s, d: serving.high_risk_positions(core_positions(s, d)),
    """select user_address, health_factor, risk_level, total_collateral_usd, total_debt_usd, utilization_rate, position_timestamp from core_positions
     where risk_level in ('CRITICAL', 'LIQUIDATABLE', 'DANGER') and total_collateral_usd >= 1000 order by health_factor, position_key limit 100""",
)
register(
    "health_trend",
    lambda s, d: serving.health_trend(cdp(s, d), AS_OF, 80),
    f"""select metrics_date, protocol, avg_health_factor, min_health_factor, critical_positions, liquidatable_positions from cdp_metrics
     where metrics_date >= {TODAY} - 80""",
    ("avg_health_factor",),
)
register(
    "large_whale_moves",
    lambda s, d: serving.large_whale_moves(movements(s, d), LAST_DAY, 24, 50_000),
    f"""select event_timestamp, from_address, to_address, token_symbol, amount, amount_usd, whale_direction, tx_hash from (
     select * from movements where event_timestamp >= {LAST_NOW} - interval 24 hours and amount_usd >= 50000 {_MOVE_ORDER} limit 100)""",
)
register(
    "latest_kpis",
    lambda s, d: serving.latest_kpis(kpis(s, d)),
    "select total_positions, unique_users, total_tvl, total_debt, avg_health_factor, at_risk_positions, volume_24h, transfers_24h, active_users_24h from kpis",
    ("avg_health_factor", "volume_24h"),
)
register(
    "protocol_comparison",
    lambda s, d: serving.protocol_comparison(summary(s, d)),
    "select protocol, unique_users, total_tvl_usd, total_debt_usd, utilization_rate, avg_health_factor, at_risk_positions from protocol_summary",
    ("avg_health_factor",),
)
register(
    "recent_liquidations",
    lambda s, d: lending.recent_liquidations(events(s, d, "2024-01-25"), "2024-01-25"),
    """select event_id, user_address, liquidator_address, collateral_asset, debt_asset, amount_text, amount_usd, event_timestamp, tx_hash from stg_lending_events
     where event_type = 'liquidation' and event_timestamp >= timestamp '2024-01-25' order by event_timestamp desc, event_id, tx_hash limit 1000""",
)


def _reserves(s, d):
    """A reserves table out of the events: one row per asset and symbol."""
    return events(s, d).groupBy(F.col("asset_address").alias("id"), F.col("asset_symbol").alias("symbol")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


register(
    "reserve_by_symbol",
    lambda s, d: serving.reserves(_reserves(s, d), "WETH"),
    "select asset_address id, asset_symbol symbol, count(*) event_count from stg_lending_events where asset_symbol = 'WETH' group by all order by id limit 1",
)
register(
    "user_reserves",
    lambda s, d: serving.user_reserves(
        events(s, d).groupBy("user_address", "asset_address").agg(F.count(F.lit(1)).alias("event_count")), _USER
    ),
    f"select user_address, asset_address, count(*) event_count from stg_lending_events where user_address = '{_USER}' group by all",
)

# --- chain consistency ------------------------------------------------------

register(
    "parent_mismatches",
    lambda s, d: chain.parent_mismatches(blocks(s, d)),
    """select b.block_number, b.block_hash, p.block_hash expected_parent, b.parent_hash actual_parent
     from raw_blocks b join raw_blocks p on b.block_number - 1 = p.block_number where b.parent_hash <> p.block_hash""",
)
register(
    "block_gaps",
    lambda s, d: chain.block_gaps(blocks(s, d).where("(block_number - 1) % 211 <> 5")),
    """select block_number - 1 missing_block, block_number from (select block_number, lag(block_number) over (order by block_number) prev from raw_blocks
      where (block_number - 1) % 211 <> 5)
     where prev is not null and prev <> block_number - 1""",
)
register(
    "verify_checkpoint",
    lambda s, d: chain.verify_checkpoint(
        blocks(s, d)
        .groupBy(F.col("miner").alias("indexer"))
        .agg(F.max("block_number").alias("last_block"), F.max_by("block_hash", "block_number").alias("h"))
        .select(
            "indexer",
            "last_block",
            F.when(F.col("last_block") % 5 == 0, "").when(F.col("last_block") % 7 == 0, "0xstale").otherwise(F.col("h")).alias("block_hash"),
        ),
        blocks(s, d),
    ),
    """select indexer, last_block, case when c.block_hash = '' then 'unverified' when c.block_hash <> b.block_hash then 'hash_mismatch' else 'verified' end status,
     case when c.block_hash <> '' and c.block_hash <> b.block_hash then (select max(block_number) - 6 from raw_blocks) else last_block + 1 end start_block
     from checkpoints c join raw_blocks b on b.block_number = c.last_block""",
)
register(
    "poll_tiers",
    lambda s, d: chain.poll_tiers(
        positions.latest_positions(raw(s, d, "raw_positions")),
        transfers(s, d).groupBy(F.col("from_address").alias("user_address")).agg(F.max(F.unix_millis("event_timestamp")).alias("last_active_ms")),
        AS_OF,
    ),
    f"""select * from (with l as (select user_address, min(health_factor) health_factor from newest_positions group by user_address),
     a as (select from_address user_address, max(epoch_us(event_timestamp) // 1000) last_active_ms from stg_transfers group by from_address),
     j as (select coalesce(l.user_address, a.user_address) user_address, health_factor, last_active_ms from l full outer join a on l.user_address = a.user_address),
     t as (select user_address, case when health_factor < 15e-1 then 'high_risk' when last_active_ms > epoch_us({NOW}) // 1000 - 86400000 then 'active'
      when last_active_ms < epoch_us({NOW}) // 1000 - 86400000 then 'inactive' end tier,
      case when health_factor < 12e-1 then 'critical' when health_factor < 15e-1 then 'warning' end severity, health_factor, last_active_ms from j)
     select * from t where tier is not null)""",
)

# --- streaming twins --------------------------------------------------------

register(
    "risk_metrics",
    lambda s, d: risk.risk_metrics(raw(s, d, "raw_positions")),
    f"""select chain, user_address, protocol, health_factor, risk_level, previous_risk_level, make_timestamp(risk_changed_ms * 1000) risk_changed_at,
     total_collateral_usd, total_debt_usd, available_borrow_usd, ltv, liquidation_threshold, block_number, make_timestamp(timestamp * 1000) updated_at, timestamp as version from risk_state""",
)
register(
    "alert_candidates",
    lambda s, d: risk.alert_candidates(risk.risk_transitions(raw(s, d, "raw_positions"))),
    "select * exclude (gap_ms, rn) from candidates",
)
register("risk_alerts", alert_rows, "select * from alerts")
register(
    "alert_messages",
    lambda s, d: risk.to_alert_json(alert_rows(s, d)).select(
        "key",
        F.get_json_object("value", "$.alert_id").alias("alert_id"),
        F.get_json_object("value", "$.severity").alias("severity"),
        F.get_json_object("value", "$.details.current_risk_level").alias("current_risk_level"),
        F.get_json_object("value", "$.details.total_debt_usd").alias("total_debt_usd"),
        F.get_json_object("value", "$.timestamp").alias("timestamp"),
    ),
    """select user_address as key, alert_id, severity, current_risk_level, cast(total_debt_usd as varchar) total_debt_usd,
     strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') as timestamp from alerts""",
)
register(
    "route_alerts",
    lambda s, d: risk.route_alerts(
        alert_rows(s, d).select("alert_id", "user_address", "severity", "alert_type"),
        views.table(s, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).select(
            F.concat(F.lit("u"), F.col("o_custkey")).alias("user_id"),
            F.expr(f"case when o_custkey % 40 <> 3 then {_W('o_custkey')} end").alias("address"),
            F.expr("case o_custkey % 4 when 0 then 'INFO' when 1 then 'WARNING' when 2 then 'HIGH' else 'CRITICAL' end").alias("min_severity"),
            F.expr("case when n % 2 = 0 then array('LIQUIDATION_RISK', 'RISK_INCREASED') end").alias("alert_types"),
        ),
    ),
    f"""select user_id, alert_id, user_address, severity, alert_type from alerts join (
      select concat('u', cast(o_custkey as varchar)) user_id, case when o_custkey % 40 <> 3 then {_W('o_custkey')} end address, 1 + o_custkey % 4 least_rank, count(*) n
      from orders group by o_custkey) c on user_address = address or address is null
     where list_position(['INFO','WARNING','HIGH','CRITICAL'], severity) >= least_rank and (n % 2 = 1 or alert_type in ('LIQUIDATION_RISK', 'RISK_INCREASED'))""",
)
register(
    "token_flow_hourly",
    lambda s, d: flows.token_flow_hourly(raw(s, d, "raw_transfers"), AS_OF),
    f"""select chain, token_address, {models.HOUR} as hour, count(*) transfer_count, count(distinct from_address) unique_senders_count, count(distinct to_address) unique_receivers_count,
     cast(sum(cast(coalesce(amount, 0e0) as decimal(38,18))) as decimal(38,18)) total_volume,
     cast(sum(cast(coalesce(amount, 0e0) as decimal(38,18))) as double) / count(*) avg_transfer_size,
     max(cast(coalesce(amount, 0e0) as decimal(38,18))) max_transfer_size, {NOW} updated_at
     from raw_transfers group by chain, token_address, {models.HOUR}""",
    ("avg_transfer_size",),
)
register("dq_window_metrics", window_metrics, "select * from dq_minute")
register("dq_window_metrics_hour", lambda s, d: window_metrics(s, d, 3_600_000, 1_800_000), "select * from dq_hour")
register(
    "detect_anomalies",
    lambda s, d: dq_windows.detect_anomalies(window_metrics(s, d, 3_600_000, 1_800_000)),
    """select o.* exclude (rn), cast(rate_flag as int) is_rate_anomaly, cast(latency_flag as int) is_latency_anomaly
     from dq_ordered o join detector t on t.topic = o.topic and t.rn = o.rn""",
)
register(
    "message_latency",
    lambda s, d: dq_windows.with_latency(spark_view(s, d, "messages")).select("topic", "offset", "latency_ms"),
    'select topic, "offset", processing_time - timestamp latency_ms from messages',
)
register(
    "message_faults",
    lambda s, d: dq_windows.message_faults(
        spark_view(s, d, "messages").withColumn("value", F.expr("case when offset % 9 = 0 then '{broken' else value end")).withColumn("offset", F.expr("offset div 3")),
        3_600_000,
        1_800_000,
    ),
    """select topic, make_timestamp(w * 1000) window_from, cast(sum(broken) as bigint) schema_error_count, cast(sum(n - 1) as bigint) duplicate_count from (
     select topic, w, partition, "offset" // 3 as o, count(*) n, count(*) filter ("offset" % 9 = 0) broken
     from (select *, timestamp - timestamp % 1800000 - k * 1800000 w from messages, range(0, 2) r(k)) group by topic, w, partition, o) group by topic, w""",
)
register(
    "latest_prices",
    lambda s, d: flows.latest_prices(records.parse_prices(spark_view(s, d, "price_json"))),
    """select symbol, price_usd, timestamp, source from (select *, row_number() over (partition by symbol order by timestamp desc, price_usd desc, source desc) rn from (
     select concat('S', cast(l_partkey % 8 as varchar)) symbol, case when l_linenumber = 1 then 0e0 else l_suppkey + 25e-2 end price_usd,
      1698796800000 + l_orderkey * 1000 as timestamp, case when l_linenumber = 2 then 'OTHER' else 'CHAINLINK' end source from price_json)) where rn = 1""",
)
models.CTES["landed"] = """select transfer_id, timestamp, block_number, log_index, from_address, to_address, amount_raw,
 row_number() over (partition by coalesce(transfer_id, tx_hash) order by timestamp, log_index, block_number, amount_raw) rn, coalesce(transfer_id, tx_hash) k from raw_transfers"""
models.CTES["landed_walk"] = """select k, rn, timestamp as last_ms, true as kept from landed where rn = 1
 union all select c.k, c.rn, case when c.timestamp - a.last_ms >= 600000 then c.timestamp else a.last_ms end, c.timestamp - a.last_ms >= 600000
 from landed_walk a join landed c on c.k = a.k and c.rn = a.rn + 1"""
register(
    "landing_dedup",
    lambda s, d: timeline.keep_spaced(
        raw(s, d, "raw_transfers").select(
            F.coalesce("transfer_id", "tx_hash").alias("k"), "timestamp", "log_index", "block_number", "amount_raw", F.lit(600_000).alias("gap")
        ),
        ["k"], "timestamp", "gap", ["log_index", "block_number", "amount_raw"],
    ).drop("gap"),
    "select c.k, c.timestamp, c.log_index, c.block_number, c.amount_raw from landed c join landed_walk a on a.k = c.k and a.rn = c.rn and a.kept",
)

# --- streams over the given tables ------------------------------------------


def _drained(spark: SparkSession, start: Callable) -> str:
    """Run a streaming job over everything there is and return its output folder."""
    use_utc(spark)
    options = JobOptions(run=f"queries-{uuid.uuid4().hex}", available_now=True)
    out = f"{checkpoint_root(spark)}/{options.run}/out"
    start(out, options).awaitTermination()
    return out


def _risk_stream(part: str) -> Query:
    def run(s, d):
        positions_stream = raw(s, d, "raw_positions", stream="orders")
        out = _drained(s, lambda o, options: jobs.start_risk(positions_stream, f"{o}/metrics", f"{o}/alerts", options))
        return sinks.read_batches(s, f"{out}/{part}")

    return run


register("stream_risk_metrics", _risk_stream("metrics"), ENTRIES["risk_metrics"].body)
register("stream_risk_alerts", _risk_stream("alerts"), "select * from alerts")


def _flow_stream(s, d):
    transfers_stream = raw(s, d, "raw_transfers", stream="lineitem")
    out = _drained(s, lambda o, options: jobs.start_token_flow(transfers_stream, o, options))
    rows = sinks.read_upserts(s, out, ["chain", "token_address", "hour"], "updated_at")
    return rows.drop("senders", "receivers", "updated_at")


register(
    "stream_token_flow",
    _flow_stream,
    "select * exclude (updated_at) from (" + ENTRIES["token_flow_hourly"].body + ")",
    ("avg_transfer_size",),
)


def _dq_windows(s, d, o, options):
    messages = spark_view(s, d, "messages", stream="events")
    return jobs.start_dq_windows(messages, o, options, window_ms=3_600_000, slide_ms=1_800_000)


def _dq_stream(s, d):
    return s.read.parquet(_drained(s, lambda o, options: _dq_windows(s, d, o, options)))


register(
    "stream_dq_windows",
    _dq_stream,
    # A window closes once the newest message lies past its end by the allowed disorder.
    "select * from dq_hour where window_to <= (select make_timestamp(max(timestamp) * 1000) from messages) - interval 5 seconds",
)


def _flag_stream(s, d):
    windows = _drained(s, lambda o, options: _dq_windows(s, d, o, options))
    closed = s.readStream.schema(s.read.parquet(windows).schema).parquet(windows)
    return sinks.read_batches(s, _drained(s, lambda o, options: jobs.start_dq_flags(closed, o, options)))


register(
    "stream_anomalies",
    _flag_stream,
    "select * from (" + ENTRIES["detect_anomalies"].body + ") where window_to <= (select make_timestamp(max(timestamp) * 1000) from messages) - interval 5 seconds",
)


def _landing_stream(part: str) -> Query:
    def run(s, d):
        messages = spark_view(s, d, "messages", stream="events")
        out = _drained(
            s, lambda o, options: jobs.start_landing(messages, "k bigint", f"{o}/rows", f"{o}/dead", "600 seconds", options)
        )
        return sinks.read_batches(s, f"{out}/{part}")

    return run


register(
    "stream_landing",
    _landing_stream("rows"),
    """select cast(value ->> '$.k' as bigint) k, partition kafka_partition, "offset" kafka_offset from messages
     where value is not null and trim(value) <> ''""",
)

register(
    "stream_dead_letters",
    _landing_stream("dead"),
    """select topic, partition, "offset", key, value, timestamp from messages where value is null or trim(value) = ''""",
)

# --- metrics ----------------------------------------------------------------


def _models(s, d, name, metric_name=None):
    source = {"address_positions": core_positions, "token_transfers": transfers, "whale_movements": movements}[name]
    return {name: source(s, d)}


def _metric(name: str, sql: str, model: str, doubles=(), as_of: str = AS_OF, **options) -> Query:
    register(
        f"metric_{name}" + ("_by_" + "_".join(options.get("group_by", ())) if options.get("group_by") else "") + (f"_{options['grain']}" if options.get("grain") else ""),
        lambda s, d: metrics.metric(_models(s, d, model), name, as_of=as_of, **options),
        sql,
        doubles,
        2 if name.endswith("volume_usd") else 6,  # dollar totals are reported to the cent
    )


_CP, _ST, _MV = "address_positions", "token_transfers", "whale_movements"
_RISKY = "filter (risk_level in ('CRITICAL', 'LIQUIDATABLE'))"
_WHALE = "filter (position_size_tier = 'whale')"
_metric("total_tvl_usd", "select sum(total_collateral_usd) total_tvl_usd from core_positions", _CP)
_metric("total_debt_usd", "select sum(total_debt_usd) total_debt_usd from core_positions", _CP)
_metric("utilization_rate", "select cast(sum(total_debt_usd) as double) / nullif(cast(sum(total_collateral_usd) as double), 0) utilization_rate from core_positions", _CP)
_metric("avg_health_factor", "select avg(health_factor) avg_health_factor from core_positions", _CP, ("avg_health_factor",))
_metric("min_health_factor", "select min(health_factor) min_health_factor from core_positions", _CP)
_metric("at_risk_tvl_usd", f"select sum(total_collateral_usd) {_RISKY} at_risk_tvl_usd from core_positions", _CP)
_metric("at_risk_ratio", f"select cast(sum(total_collateral_usd) {_RISKY} as double) / nullif(cast(sum(total_collateral_usd) as double), 0) at_risk_ratio from core_positions", _CP)
_metric("total_users", "select count(distinct user_address) total_users from core_positions", _CP)
_metric("total_positions", "select count(position_key) total_positions from core_positions", _CP)
_metric("daily_active_users", f"select count(distinct from_address) daily_active_users from stg_transfers where event_date = {LAST_DATE}", _ST, as_of=LAST_DAY)
_metric("total_transfer_volume_usd", "select sum(amount_usd) total_transfer_volume_usd from stg_transfers", _ST, ("total_transfer_volume_usd",))
_metric("daily_volume_usd", f"select coalesce(sum(amount_usd), 0e0) daily_volume_usd from stg_transfers where event_date = {LAST_DATE}", _ST, ("daily_volume_usd",), LAST_DAY)
_metric("weekly_volume_usd", f"select coalesce(sum(amount_usd), 0e0) weekly_volume_usd from stg_transfers where event_date >= {TODAY} - 7", _ST, ("weekly_volume_usd",))
_metric("total_transfers", "select count(transfer_id) total_transfers from stg_transfers", _ST)
_metric("avg_transfer_size_usd", "select avg(amount_usd) avg_transfer_size_usd from stg_transfers", _ST, ("avg_transfer_size_usd",))
_metric("whale_positions_count", f"select count(position_key) {_WHALE} whale_positions_count from core_positions", _CP)
_metric("whale_tvl_usd", f"select sum(total_collateral_usd) {_WHALE} whale_tvl_usd from core_positions", _CP)
_metric("whale_tvl_share", f"select cast(sum(total_collateral_usd) {_WHALE} as double) / nullif(cast(sum(total_collateral_usd) as double), 0) whale_tvl_share from core_positions", _CP)
_metric("whale_movement_volume_usd", "select sum(amount_usd) whale_movement_volume_usd from movements", _MV, ("whale_movement_volume_usd",))
_metric("whale_movement_count", "select count(movement_id) whale_movement_count from movements", _MV)
_metric("total_tvl_usd", "select risk_level, sum(total_collateral_usd) total_tvl_usd from core_positions group by risk_level", _CP, group_by=("risk_level",))
_metric("total_transfer_volume_usd", "select date_trunc('day', event_timestamp) metric_time, sum(amount_usd) total_transfer_volume_usd from stg_transfers group by 1", _ST, ("total_transfer_volume_usd",), grain="day")
_metric("total_transfers", "select token_symbol, date_trunc('hour', event_timestamp) metric_time, count(transfer_id) total_transfers from stg_transfers group by all", _ST, group_by=("token_symbol",), grain="hour")
_metric(
    "whale_tvl_share",
    f"select protocol, cast(coalesce(sum(total_collateral_usd) {_WHALE}, 0) as double) / nullif(cast(sum(total_collateral_usd) as double), 0) whale_tvl_share from core_positions group by protocol",
    _CP,
    group_by=("protocol",),
)
register(
    "measure_unique_receivers",
    lambda s, d: metrics.measure(transfers(s, d), "token_transfers", "unique_receivers", ("transfer_type",)),
    "select transfer_type, count(distinct to_address) unique_receivers from stg_transfers group by transfer_type",
)

# --- checks -----------------------------------------------------------------

register(
    "check_unique",
    lambda s, d: checks.unique(transfers(s, d), "transfer_id"),
    "select transfer_id unique_field, count(*) n_records from stg_transfers where transfer_id is not null group by transfer_id having count(*) > 1",
)
register(
    "check_not_null",
    lambda s, d: checks.not_null(raw(s, d, "raw_transfers"), "transfer_id").select("tx_hash", "log_index", "block_number"),
    "select tx_hash, log_index, block_number from raw_transfers where transfer_id is null",
)
register(
    "check_accepted_values",
    lambda s, d: checks.accepted_values(events(s, d), "event_type", list(lending.PIVOTED_EVENTS)),
    "select event_type value_field, count(*) n_records from stg_lending_events where event_type not in ('supply', 'withdraw', 'borrow', 'repay', 'liquidation') group by event_type",
)
register(
    "check_accepted_range",
    lambda s, d: checks.accepted_range(raw(s, d, "raw_positions"), "health_factor", 1, 2).select("user_address", "block_number", "health_factor"),
    "select user_address, block_number, health_factor from raw_positions where health_factor < 1 or health_factor > 2",
)
register(
    "check_unique_combination",
    lambda s, d: checks.unique_combination(transfers(s, d), ["event_date", "from_address", "token_address"]),
    "select event_date, from_address, token_address from stg_transfers group by all having count(*) > 1",
)
register(
    "check_positive_value",
    lambda s, d: checks.positive_value(netflow(s, d).withColumn("net_usd", F.round("net_usd", 2)), "net_usd"),
    "select round(net_usd, 2) invalid_value from netflow where round(net_usd, 2) < 0",
    ("invalid_value",),
)
register(
    "check_valid_address",
    lambda s, d: checks.valid_address(raw(s, d, "raw_blocks").withColumn("miner", F.expr("case when block_number % 13 = 0 then substring(miner, 3, 42) else miner end")), "miner"),
    "select substring(miner, 3, 42) invalid_address from raw_blocks where block_number % 13 = 0",
)
register(
    "check_recent_data",
    lambda s, d: checks.recent_data(staging.stg_blocks(blocks(s, d)), "block_timestamp", AS_OF, 1),
    f"select count(*) row_count from stg_blocks having max(block_timestamp) < {NOW} - interval 1 day",
)
register(
    "check_no_duplicates",
    lambda s, d: checks.no_duplicates(raw(s, d, "raw_transfers"), ["tx_hash", "log_index"]),
    "select tx_hash, log_index, count(*) cnt from raw_transfers group by all having count(*) > 1",
)
register(
    "check_freshness",
    lambda s, d: checks.freshness(staging.stg_blocks(blocks(s, d)), "block_timestamp", 300, AS_OF, "raw_blocks_freshness"),
    f"""select 'raw_blocks_freshness' check_name, cast(epoch({NOW}) as bigint) - cast(epoch(max(block_timestamp)) as bigint) delay_seconds, cast(300 as bigint) threshold_seconds,
     cast(epoch({NOW}) as bigint) - cast(epoch(max(block_timestamp)) as bigint) > 300 failed from stg_blocks""",
)
register(
    "check_completeness",
    lambda s, d: checks.completeness(raw(s, d, "raw_transfers"), ["amount", "amount_usd"], "transfers_not_null"),
    """select 'transfers_not_null' check_name, count(*) total, (count(*) filter (amount is null) + count(*) filter (amount_usd is null)) / (count(*) * 2e0) null_rate,
     (count(*) filter (amount is null) + count(*) filter (amount_usd is null)) / (count(*) * 2e0) > 1e-2 failed from raw_transfers""",
)
register(
    "check_consistency",
    lambda s, d: checks.consistency(core_positions(s, d).withColumn("health_factor", F.col("health_factor") - 1), AS_OF),
    """select count(*) total, count(*) filter (health_factor - 1 < 0) negative_hf, count(*) filter (health_factor - 1 > 1000) extreme_hf,
     count(*) filter (health_factor - 1 < 0) > 0 or count(*) filter (health_factor - 1 > 1000) > 0 failed from core_positions""",
)
register(
    "check_positions_health",
    lambda s, d: checks.positions_health_check(core_positions(s, d), AS_OF),
    f"""select count(*) total, cast(0 as bigint) delay_seconds, false stale, 0e0 null_rate, false incomplete,
     count(*) filter (health_factor < 0 or health_factor > 1000) > 0 inconsistent from core_positions""",
)

from oracle import flowing, signals, stored  # noqa: E402, F401  they add their own queries
