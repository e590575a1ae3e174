"""Event logs to typed transfers and lending events, as one projection over the log table.

A log is an address, up to four topics and a data field of 32-byte words.
The first topic picks the event; everything else is positional, so each
output column is a `when` over the topic with substrings of the hex text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import dash_key

# First topic of each event.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
SUPPLY_TOPIC = "0x2b627736bca15cd5381dcf80b0bf11fd197d01a037c52b927a881a10fb73ba61"
WITHDRAW_TOPIC = "0x3115d1449a7b732c986cba18244e897a450f61e1bb8d589cd2e69e6c8924f9f7"
BORROW_TOPIC = "0xb3d084820fb1a9decffb176436bd02558d15fac9b0ddfed8c465bc7359d7dce0"
REPAY_TOPIC = "0xa534c8dbe71f871f9f3530e97a74601fea17b426cae02e1c5aee42c96c784051"
LIQUIDATION_TOPIC = "0xe413a321e8681d831f4dbccbca790d2952b56f977908e45be37335533e005286"
FLASH_LOAN_TOPIC = "0xefefaba5e921573100900a3ad9cf29f222d995fb3b6045797eaea7521bd8d6f0"

# Where each lending event keeps its fields. `topic n` counts
# from 1 after the first topic, `word n` counts data words from 0.
LENDING_LAYOUT = {
    "SUPPLY": (SUPPLY_TOPIC, {"asset": ("topic", 1), "user": ("word", 0), "on_behalf_of": ("topic", 2), "amount": 1}),
    "WITHDRAW": (WITHDRAW_TOPIC, {"asset": ("topic", 1), "user": ("topic", 2), "amount": 0}),
    "BORROW": (BORROW_TOPIC, {"asset": ("topic", 1), "user": ("word", 0), "on_behalf_of": ("topic", 2), "amount": 1}),
    "REPAY": (REPAY_TOPIC, {"asset": ("topic", 1), "user": ("topic", 2), "amount": 0}),
    "LIQUIDATION": (
        LIQUIDATION_TOPIC,
        {
            "asset": ("topic", 2),
            "user": ("topic", 3),
            "amount": 1,
            "liquidator": ("word", 2),
            "collateral_asset": ("topic", 1),
            "debt_to_cover": 0,
        },
    ),
    "FLASH_LOAN": (FLASH_LOAN_TOPIC, {"asset": ("topic", 2), "user": ("word", 0), "amount": 1}),
}


def topic(position: int) -> Column:
    """The nth topic after the first, NULL when the log has fewer."""
    return F.try_element_at(F.col("topics"), F.lit(position + 1))


def word(position: int) -> Column:
    """The nth 32-byte data word as 64 hex digits."""
    return F.substring("data", 3 + 64 * position, 64)


def address_of(hex_word: Column) -> Column:
    """The low 20 bytes of a 32-byte value."""
    return F.lower(F.concat(F.lit("0x"), F.right(hex_word, F.lit(40))))


_LIMB_BITS, _LIMBS, _CHUNK, _CHUNKS = 28, 10, 10**9, 9


def uint_text(hex_digits: Column) -> Column:
    """Unsigned hex of up to 32 bytes to decimal text, exact over the full range.

    The value is taken in limbs of 28 bits. Each power of the limbs' base is written in chunks of nine decimal digits, so
    a chunk of the value is a sum of ten products below 2^58 and one pass of carries is left; all of it fits 64 bits.
    """
    padded = F.lpad(hex_digits, 70, "0")
    limbs = F.array(*[F.conv(F.substring(padded, i * 7 + 1, 7), 16, 10).cast("bigint") for i in reversed(range(_LIMBS))])
    powers = [[(1 << (_LIMB_BITS * i)) // _CHUNK**k % _CHUNK for i in range(_LIMBS)] for k in range(_CHUNKS)]
    rows = F.array(*[F.array(*[F.lit(p).cast("bigint") for p in row]) for row in powers])

    def written(own: Column) -> Column:
        def add(acc: Column, row: Column) -> Column:
            total = acc["carry"]
            for i in range(_LIMBS):
                total = total + own[i] * row[i]
            digits = F.lpad((total % _CHUNK).cast("string"), 9, "0")
            return F.struct(F.call_function("div", total, F.lit(_CHUNK).cast("bigint")).alias("carry"), F.concat(digits, acc["out"]).alias("out"))

        return F.aggregate(rows, F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("out")), add)["out"]

    # The limbs are bound to a name, so that they are read once.
    text = F.transform(F.array(limbs), written)[0]
    trimmed = F.ltrim(text, F.lit("0"))
    return F.when(trimmed == "", "0").otherwise(trimmed)


def uint_value(hex_word: Column) -> Column:
    """Decimal text of a 32-byte word of 64 hex digits; plain `conv` below 2^60, limbs above."""
    small = F.substring(hex_word, 1, 49) == "0" * 49
    return F.when(small, F.conv(F.substring(hex_word, 50, 15), 16, 10)).otherwise(uint_text(hex_word))


def _event_key() -> Column:
    return dash_key("tx_hash", "log_index")


def decode_transfers(logs: DataFrame, chain: str = "base") -> DataFrame:
    """Token transfers: the transfer topic with exactly two indexed addresses."""
    return logs.where((F.size("topics") == 3) & (F.lower(F.col("topics")[0]) == TRANSFER_TOPIC)).select(
        _event_key().alias("transfer_id"),
        F.lit(chain).alias("chain"),
        F.lower("address").alias("token_address"),
        address_of(topic(1)).alias("from_address"),
        address_of(topic(2)).alias("to_address"),
        uint_value(F.substring("data", 3, 64)).alias("amount_raw"),
        "block_number",
        "tx_hash",
        "log_index",
        "timestamp",
    )


def decode_lending_events(logs: DataFrame, chain: str = "base", protocol: str = "aave_v3") -> DataFrame:
    """Lending-pool events; logs with any other first topic are left out."""
    first = F.lower(F.try_element_at(F.col("topics"), F.lit(1)))

    def by_event(field: str, as_number: bool) -> Column:
        value = F.lit(None).cast("string")
        for signature, layout in LENDING_LAYOUT.values():
            if field not in layout:
                continue
            place = layout[field]
            if as_number:
                source = uint_value(word(place))
            else:
                kind, position = place
                source = address_of(topic(position) if kind == "topic" else word(position))
            value = F.when(first == signature, source).otherwise(value)
        return value

    kind = F.lit(None).cast("string")
    for name, (signature, _) in LENDING_LAYOUT.items():
        kind = F.when(first == signature, F.lit(name)).otherwise(kind)

    # One amount word per event, picked first, so the conversion appears once.
    amount_word = F.lit(None).cast("string")
    for signature, layout in LENDING_LAYOUT.values():
        amount_word = F.when(first == signature, word(layout["amount"])).otherwise(amount_word)

    known = [signature for signature, _ in LENDING_LAYOUT.values()]
    return logs.where(first.isin(known)).select(
        _event_key().alias("event_id"),
        kind.alias("event_type"),
        F.lit(protocol).alias("protocol"),
        F.lit(chain).alias("chain"),
        by_event("user", False).alias("user_address"),
        by_event("asset", False).alias("asset_address"),
        uint_value(amount_word).alias("amount"),
        by_event("on_behalf_of", False).alias("on_behalf_of"),
        by_event("liquidator", False).alias("liquidator_address"),
        by_event("collateral_asset", False).alias("collateral_asset"),
        by_event("debt_to_cover", True).alias("debt_to_cover"),
        "block_number",
        "tx_hash",
        "log_index",
        "timestamp",
    )
