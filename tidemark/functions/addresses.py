"""Address helpers; every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"


def normalize_address(address: Column) -> Column:
    return F.lower(address)


def is_zero_address(address: Column) -> Column:
    return normalize_address(address) == ZERO_ADDRESS


def is_valid_address(address: Column, strict: bool = True) -> Column:
    """Strict asks for 40 hex digits; otherwise only length and prefix count."""
    if strict:
        return address.rlike("^0x[a-fA-F0-9]{40}$")
    return (F.length(address) == 42) & (F.substring(address, 1, 2) == "0x")


def truncate_address(address: Column, prefix: int = 6, suffix: int = 4, guard: bool = True) -> Column:
    """`0x1234...abcd`. With `guard`, strings too short to gain from it stay whole."""
    short = F.concat(
        F.substring(address, 1, prefix),
        F.lit("..."),
        F.substring(address, F.length(address) - F.lit(suffix - 1), F.lit(suffix)),
    )
    if not guard:
        return short
    return F.when(F.length(address) < prefix + suffix + 3, address).otherwise(short)
