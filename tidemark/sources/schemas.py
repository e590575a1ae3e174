"""Canonical input schemas. `timestamp` is always epoch milliseconds."""

from __future__ import annotations

# Column names and types of the raw tables, as DDL text.
BLOCKS = """
    block_number bigint, block_hash string, parent_hash string, timestamp bigint,
    transaction_count int, gas_used bigint, gas_limit bigint, base_fee_per_gas string,
    miner string, kafka_partition int, kafka_offset bigint
"""

LENDING_EVENTS = """
    chain string, protocol string, event_type string, user_address string,
    asset_address string, asset_symbol string, amount string, amount_usd double,
    liquidator_address string, collateral_asset string, debt_asset string,
    block_number bigint, tx_hash string, log_index int, timestamp bigint,
    kafka_partition int, kafka_offset bigint
"""

TRANSFERS = """
    transfer_id string, chain string, token_address string, token_symbol string,
    token_decimals int, from_address string, to_address string, amount_raw string,
    amount double, amount_usd double, block_number bigint, tx_hash string,
    log_index int, timestamp bigint
"""

POSITIONS = """
    chain string, protocol string, user_address string, block_number bigint,
    health_factor double, total_collateral_usd decimal(38,8), total_debt_usd decimal(38,8),
    available_borrow_usd decimal(38,8), ltv double, liquidation_threshold double,
    collateral_assets string, debt_assets string, timestamp bigint,
    kafka_partition int, kafka_offset bigint
"""

PRICES = """
    chain string, token_address string, token_symbol string, price_usd double,
    price_eth double, market_cap_usd decimal(38,2), volume_24h_usd decimal(38,2),
    price_change_24h_pct double, price_source string, timestamp bigint
"""

RISK_METRICS = """
    chain string, user_address string, protocol string, health_factor double,
    risk_level string, previous_risk_level string, risk_changed_at timestamp,
    total_collateral_usd decimal(38,8), total_debt_usd decimal(38,8),
    available_borrow_usd decimal(38,8), ltv double, liquidation_threshold double,
    block_number bigint, updated_at timestamp, version bigint
"""

MESSAGES = """
    topic string, partition int, offset bigint, key string, value string,
    timestamp bigint, headers map<string,string>, processing_time bigint
"""

LOGS = """
    address string, topics array<string>, data string, block_number bigint,
    tx_hash string, log_index int, timestamp bigint
"""

# Other spellings of a canonical column, tried in this order.
ALIASES = {
    "transaction_count": ("tx_count",),
    "asset_address": ("reserve_address",),
    "liquidator_address": ("liquidator",),
    "liquidation_threshold": ("current_liquidation_threshold",),
    "token_address": ("asset_address",),
    "token_symbol": ("asset_symbol",),
    "price_source": ("source",),
}
