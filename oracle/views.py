"""Domain tables derived from the given tables, in one SQL text for both engines.

`spark_view` runs the text in Spark over the Parquet files; `with_ctes` puts
it (and the model texts built on it) in front of a DuckDB query.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import use_utc
from tidemark.sources import logs, schemas
from tidemark.sources.raw import conform

AS_OF = "2024-01-30 12:00:00"
TODAY = "date '2024-01-30'"
NOW = f"timestamp '{AS_OF}'"


def _address(value: str) -> str:
    return f"concat('0x', lpad(cast({value} as string), 40, '0'))"


def _hash(value: str) -> str:
    return f"concat('0x', md5(cast({value} as string)), md5(concat('b', cast({value} as string))))"


def _word(value: str) -> str:
    return f"lpad(lower(hex({value})), 64, '0')"


# Amounts of 70 to 256 bits, some just under a multiple of a power of ten, by remainder of the order.
WIDE = (10**21 - 1, 10**24 - 1, 5 * 10**23 - 1, 165526809772148999999999, 2**255 + 999_999_937, 2**256 - 1)
_WIDE_WORDS = " ".join(f"when {i} then '{n:064x}'" for i, n in enumerate(WIDE))

_SHIPPED = "1698796800000 + ((MS(l_shipdate) - 788918400000) % 7776000000)"
_TRANSFER_TIME = f"{_SHIPPED} + l_linenumber * 3600000 + (l_orderkey % 3600) * 1000"

VIEWS = {
    "raw_transfers": (
        ["lineitem", "orders"],
        f"""select 'base' as chain,
 case when l_linenumber = 2 then null else concat(cast(l_orderkey as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string), '-', cast(l_linenumber as string)) end as transfer_id,
 {_address('900000 + l_partkey % 8')} as token_address,
 case l_partkey % 8 when 0 then 'USDC' when 1 then 'weth' when 2 then 'DAI' when 3 then null else concat('TK', cast(l_partkey % 8 as string)) end as token_symbol,
 case l_partkey % 8 when 0 then 6 when 3 then null else 18 end as token_decimals,
 {_address('o_custkey')} as from_address, {_address('l_suppkey')} as to_address,
 cast(cast(round(l_quantity * 1e6) as bigint) as string) as amount_raw,
 case when l_linenumber = 1 then null else l_quantity end as amount,
 case when l_linenumber = 3 then null else l_extendedprice end as amount_usd,
 o_orderkey + 1 as block_number, {_hash('l_orderkey')} as tx_hash, l_linenumber as log_index,
 {_TRANSFER_TIME} as timestamp
 from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "raw_positions": (
        ["orders"],
        f"""select 'base' as chain,
 case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'aave_v3' else 'compound_v3' end as protocol,
 {_address('o_custkey')} as user_address, o_orderkey + 1 as block_number,
 8e-1 / (3e-1 + ((o_orderkey * 37) % 60) / 1e2) as health_factor,
 cast(o_totalprice * 4e0 as decimal(38,8)) as total_collateral_usd,
 cast(round(o_totalprice * 4e0 * (3e-1 + ((o_orderkey * 37) % 60) / 1e2), 2) as decimal(38,8)) as total_debt_usd,
 cast(o_totalprice as decimal(38,8)) as available_borrow_usd,
 75e-2 as ltv, 8e-1 as liquidation_threshold,
 cast(null as string) as collateral_assets, cast(null as string) as debt_assets,
 1698796800000 + o_orderkey * 20000 + (o_orderkey - o_orderkey % 5000) * 138240 as timestamp
 from orders""",
    ),
    "raw_lending_events": (
        ["events"],
        f"""select case when event_id % 97 = 0 then 'other' else 'base' end as chain,
 case when user_id % 3 = 0 then 'AAVE_V3' when user_id % 3 = 1 then 'aave_v3' else 'compound_v3' end as protocol,
 case when event_id % 100 = 7 then 'FLASH_LOAN' when event_type = 'view' then 'SUPPLY' when event_type = 'click' then 'WITHDRAW' when event_type = 'purchase' then 'BORROW' when event_type = 'signup' then 'REPAY' else 'LIQUIDATION' end as event_type,
 {_address('user_id')} as user_address, {_address('900000 + user_id % 8')} as asset_address,
 case user_id % 8 when 0 then 'USDC' when 3 then null else 'weth' end as asset_symbol,
 cast(cast(round(value * 1e6) as bigint) as string) as amount,
 case when event_id % 40 = 0 then null else value end as amount_usd,
 case when event_type = 'error' then {_address('user_id + 1')} end as liquidator_address,
 case when event_type = 'error' then {_address('900001')} end as collateral_asset,
 case when event_type = 'error' then {_address('900000')} end as debt_asset,
 event_id + 1 as block_number, {_hash('event_id')} as tx_hash, cast(event_id % 7 as int) as log_index, MS(ts) as timestamp
 from events""",
    ),
    "raw_prices": (
        ["lineitem"],
        f"""select 'base' as chain, {_address('900000 + l_partkey % 8')} as token_address,
 case l_partkey % 8 when 0 then 'USDC' when 3 then null else 'weth' end as token_symbol,
 case when l_partkey % 50 = 0 then 0e0 else l_extendedprice / l_quantity end as price_usd,
 cast(null as double) as price_eth, 'CHAINLINK' as price_source,
 {_SHIPPED} + (l_orderkey % 86400) * 1000 as timestamp
 from lineitem""",
    ),
    "raw_blocks": (
        ["orders"],
        f"""select o_orderkey + 1 as block_number, {_hash('o_orderkey + 1')} as block_hash,
 case when o_orderkey % 97 = 0 then {_hash('o_orderkey + 900000000')} else {_hash('o_orderkey')} end as parent_hash,
 1698796800000 + o_orderkey * 2000 as timestamp, cast(o_orderkey % 50 as int) as transaction_count,
 (o_orderkey * 7919) % 30000000 as gas_used, case when o_orderkey % 53 = 0 then 0 else 30000000 end as gas_limit, {_address('o_custkey')} as miner
 from orders""",
    ),
    "messages": (
        ["events"],
        """select concat('topic.', event_type) as topic, cast(user_id % 4 as int) as partition, event_id as `offset`, cast(user_id as string) as key,
 case when event_id % 50 = 0 then null when event_id % 75 = 1 then '  ' else props end as value,
 MS(ts) as timestamp, MS(ts) + cast(round(value * 5e2) as bigint) as processing_time from events""",
    ),
    "raw_transfer_logs": (
        ["lineitem", "orders"],
        f"""select {_address('900000 + l_partkey % 8')} as address, '{logs.TRANSFER_TOPIC}' as topic0,
 concat('0x', {_word('o_custkey')}) as topic1, concat('0x', {_word('l_suppkey')}) as topic2, cast(null as string) as topic3,
 concat('0x', case o_orderkey % 50 {_WIDE_WORDS} else {_word('cast(round(l_quantity * 1e6) as bigint)')} end) as data, o_orderkey + 1 as block_number,
 {_hash('l_orderkey')} as tx_hash, l_linenumber as log_index, {_TRANSFER_TIME} as timestamp
 from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "raw_lending_logs": (
        ["events"],
        f"""select {_address('700000')} as address,
 case when event_id % 100 = 7 then '{logs.FLASH_LOAN_TOPIC}' when event_type = 'view' then '{logs.SUPPLY_TOPIC}' when event_type = 'click' then '{logs.WITHDRAW_TOPIC}'
  when event_type = 'purchase' then '{logs.BORROW_TOPIC}' when event_type = 'signup' then '{logs.REPAY_TOPIC}' else '{logs.LIQUIDATION_TOPIC}' end as topic0,
 concat('0x', {_word('900000 + user_id % 8')}) as topic1, concat('0x', {_word('800000 + user_id')}) as topic2, concat('0x', {_word('600000 + event_id')}) as topic3,
 concat('0x', {_word('500000 + user_id')}, {_word('cast(round(value * 1e6) as bigint)')}, {_word('400000 + event_id')}, {_word('cast(1 as bigint)')}) as data,
 event_id + 1 as block_number, {_hash('event_id')} as tx_hash, cast(event_id % 7 as int) as log_index, MS(ts) as timestamp
 from events""",
    ),
    "position_json": (
        ["orders"],
        f"""select concat('{{"user_address":"', {_address('o_custkey')}, '","block_number":', cast(o_orderkey + 1 as string),
  case when o_orderkey % 5 = 0 then '' else ',"health_factor":1.25,"protocol":"compound_v3"' end,
  case when o_orderkey % 3 = 0 then '' else concat(',"total_collateral_usd":', cast(o_custkey as string), '.5') end,
  case when o_orderkey % 2 = 0 then ',"liquidation_threshold":0.75' when o_orderkey % 7 = 0 then '' else ',"current_liquidation_threshold":0.5' end,
  case when o_orderkey % 11 = 0 then '' else concat(',"timestamp":', cast(1698796800000 + o_orderkey * 2000 as string)) end,
  ',"extra":[1,2]}}') as value, o_orderkey, o_custkey from orders""",
    ),
    "price_json": (
        ["lineitem"],
        f"""select concat('{{"asset_symbol":"S', cast(l_partkey % 8 as string), '"',
  case when l_linenumber = 1 then '' else concat(',"price_usd":', cast(l_suppkey as string), '.25') end,
  case when l_linenumber = 2 then ',"source":"OTHER"' else '' end,
  ',"asset_address":"', {_address('900000 + l_partkey % 8')}, '","timestamp":', cast(1698796800000 + l_orderkey * 1000 as string), '}}') as value,
  l_partkey, l_linenumber, l_suppkey, l_orderkey from lineitem""",
    ),
    "transfer_json": (
        ["lineitem"],
        f"""select concat('{{"tx_hash":"', {_hash('l_orderkey')}, '","log_index":', cast(l_linenumber as string),
  case when l_linenumber = 2 then '' else concat(',"transfer_id":"', cast(l_orderkey as string), '-', cast(l_partkey as string), '"') end,
  case when l_linenumber = 3 then '' else concat(',"amount":', cast(l_suppkey as string), '.5') end,
  case when l_linenumber = 4 then '' else ',"token_symbol":"USDC","token_decimals":6' end,
  case when l_linenumber = 5 then '' else ',"amount_raw":"115792089237316195423570985008687907853269984665640564039457584007913129639935"' end,
  ',"timestamp":', cast(1698796800000 + l_orderkey * 1000 as string), '}}') as value,
  l_orderkey, l_partkey, l_linenumber, l_suppkey from lineitem""",
    ),
    "alert_policies": (
        ["supplier"],
        """select concat('p', cast(s_suppkey as string)) as name,
 case s_suppkey % 7 when 5 then '{broken' when 6 then '{"metric":"health_factor","operator":"<","cooldown_minutes":5}'
  else concat('{"metric":"', case when s_suppkey % 7 = 4 then 'amount_usd' else 'health_factor' end,
   '","operator":"', case s_suppkey % 7 when 4 then '>' when 3 then '>=' when 2 then '<=' else '<' end,
   '","threshold":', case s_suppkey % 7 when 4 then cast(60000 + s_suppkey % 100 * 200 as string) when 3 then concat('2.', cast(s_suppkey % 6 as string)) else concat('1.', lpad(cast(s_suppkey % 50 as string), 2, '0')) end,
   case when s_suppkey % 3 = 0 then '' else concat(',"cooldown_minutes":', cast(s_suppkey % 4 * 1000 as string)) end, '}') end as config,
 case when s_suppkey % 5 = 1 then null else s_suppkey % 11 <> 10 end as enabled from supplier""",
    ),
    "alert_configs": (
        ["supplier"],
        f"""select s_suppkey as id, concat('u', cast(s_suppkey % 9 as string)) as user_id,
 case s_suppkey % 4 when 0 then 'address_watch' when 1 then 'risk_threshold' when 2 then 'whale_alert' else 'unknown' end as config_type,
 case when s_suppkey % 13 = 0 then null when s_suppkey % 13 = 1 then '{{"addresses": broken' when s_suppkey % 4 = 0
  then concat('{{"addresses":["', upper({_address('s_suppkey')}), '","', {_address('s_suppkey + 1')}, '",null],"min_severity":"', case when s_suppkey % 8 = 0 then 'WARNING' else 'LOUD' end, '"}}')
  when s_suppkey % 4 = 1 then concat('{{"risk_levels":["critical","LIQUIDATABLE"],"min_collateral_usd":', cast(s_suppkey * 1000 as string), '}}')
  else concat('{{"min_amount_usd":', cast(80000 + s_suppkey % 100 * 250 as string), case when s_suppkey % 3 = 0 then '' else ',"tokens":["usdc","TK5"]' end, '}}') end as config_value,
 s_suppkey % 17 <> 5 as enabled from supplier""",
    ),
    "user_watchlist": (
        ["customer"],
        f"""select c_custkey as id, concat('u', cast(c_custkey % 9 as string)) as user_id, {_address('c_custkey')} as address,
 case when c_custkey % 6 = 0 then null else c_custkey % 6 <> 1 end as alert_on_risk, c_custkey % 8 = 0 as alert_on_activity,
 case when c_custkey % 4 = 0 then null else cast(1 + c_custkey % 50 / 1e2 as decimal(5,2)) end as risk_threshold from customer""",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _expand_ms(sql: str, template: str) -> str:
    out = sql
    for column in ("l_shipdate", "ts"):
        out = out.replace(f"MS({column})", template.format(column))
    return out


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, one file or a folder of files, as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def spark_view(spark: SparkSession, sf_dir: str, name: str, stream: str | None = None) -> DataFrame:
    """A fixture view as a DataFrame; no temporary view is registered. With
    `stream`, that table is read as a stream and the view becomes one."""
    use_utc(spark)
    sources, sql = VIEWS[name]
    text = _expand_ms(sql, "unix_millis(cast({} as timestamp))").replace("{", "{{").replace("}", "}}")
    frames = {}
    for source in sources:
        frames[source] = (table_stream if source == stream else table)(spark, sf_dir, source)
        text = reduce(lambda t, word: t.replace(f"{word} {source}", f"{word} {{{source}}}"), ("from", "join"), text)
    return spark.sql(text, **frames)


_RAW_DDL = {
    "raw_transfers": schemas.TRANSFERS,
    "raw_positions": schemas.POSITIONS,
    "raw_lending_events": schemas.LENDING_EVENTS,
    "raw_prices": schemas.PRICES,
    "raw_blocks": schemas.BLOCKS,
}


def raw(spark: SparkSession, sf_dir: str, name: str, stream: str | None = None) -> DataFrame:
    """A fixture view in the canonical schema."""
    return conform(spark_view(spark, sf_dir, name, stream), _RAW_DDL[name])


def raw_logs(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark_view(spark, sf_dir, name)
    topics = F.filter(F.array("topic0", "topic1", "topic2", "topic3"), lambda t: t.isNotNull())
    return df.select("address", topics.alias("topics"), "data", "block_number", "tx_hash", "log_index", "timestamp")


def rt_risk(spark: SparkSession, sf_dir: str, part: str = "true") -> DataFrame:
    """Real-time risk rows for the accounts' snapshots, or for those that meet `part`."""
    from tidemark.functions.risk import risk_level
    from tidemark.functions.values import from_millis

    return (
        raw(spark, sf_dir, "raw_positions")
        .where(part)
        .select(
            "chain",
            "user_address",
            "protocol",
            "health_factor",
            risk_level(F.col("health_factor")).alias("risk_level"),
            F.lit("SAFE").alias("previous_risk_level"),
            from_millis(F.col("timestamp")).alias("risk_changed_at"),
            "total_collateral_usd",
            "total_debt_usd",
            "available_borrow_usd",
            "ltv",
            "liquidation_threshold",
            "block_number",
            from_millis(F.col("timestamp")).alias("updated_at"),
            F.col("block_number").alias("version"),
        )
    )


def duck_view(name: str) -> str:
    return _expand_ms(VIEWS[name][1], "(epoch_us({}) // 1000)").replace("`", '"')
