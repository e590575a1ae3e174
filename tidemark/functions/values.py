"""Time, number and text helpers."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import HOUR_MS


def moment(as_of: str | datetime) -> Column:
    """A UTC instant as a foldable timestamp literal."""
    return F.lit(_utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def moment_ms(as_of: str | datetime) -> int:
    return round(_utc(as_of).timestamp() * 1000)


def day_of(as_of: str | datetime) -> date:
    return _utc(as_of).date()


def _utc(value: str | datetime) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def date_of_millis(millis: Column) -> Column:
    return F.to_date(F.timestamp_millis(millis))


def hour_of_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis - F.pmod(millis, F.lit(HOUR_MS)))


def sum_or_zero(value: Column) -> Column:
    """The source dialect returns 0, not NULL, for a sum over no rows."""
    return F.coalesce(F.sum(value), F.lit(0))


def sum_if(value: Column, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def money_text(value: Column) -> Column:
    return F.format_string("%.2f", value.cast("double"))


def number_text(value: Column) -> Column:
    """A double as plain digits without an exponent or trailing zeros."""
    digits = value.try_cast("decimal(38,18)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), "\\.$", "")
    return F.when(value == 0, "0").otherwise(F.coalesce(plain, value.cast("string")))


def scaled(raw: Column, digits: int) -> Column:
    """Integer contract value to a double with `digits` decimals taken off."""
    return raw.cast("double") / F.lit(float(10**digits))


def dash_key(*columns: str | Column) -> Column:
    """Columns joined by dashes; NULL as soon as one of them is NULL."""
    parts: list[Column] = []
    for column in columns:
        value = F.col(column) if isinstance(column, str) else column
        parts += [F.lit("-"), value.cast("string")]
    return F.concat(*parts[1:])
