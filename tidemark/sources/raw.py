"""Readers for the raw tables and the adapter between their spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import schemas


def _millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds from a number, a timestamp or an ISO-8601 string."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_millis(column.cast("timestamp"))
    if isinstance(kind, T.StringType):
        return F.coalesce(column.try_cast("bigint"), F.unix_millis(F.try_to_timestamp(column)))
    return column.cast("bigint")


def conform(df: DataFrame, ddl: str, aliases: dict[str, tuple[str, ...]] = schemas.ALIASES) -> DataFrame:
    """Project `df` onto a canonical schema.

    A column may appear under its own name, under another spelling, or not at
    all; what is missing becomes NULL. Only the columns of the schema are read.
    """
    target = T.StructType.fromDDL(ddl)
    names = {field.name for field in target.fields}
    columns = []
    for field in target.fields:
        spellings = [field.name] + [a for a in aliases.get(field.name, ()) if a not in names]
        found = [s for s in spellings if s in df.columns]
        if field.name == "timestamp" and found:
            value = _millis(df, found[0])
        elif found:
            value = F.coalesce(*[F.col(s).cast(field.dataType) for s in found])
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _read(spark: SparkSession, path: str, ddl: str, file_format: str) -> DataFrame:
    return conform(spark.read.format(file_format).load(path), ddl)


def raw_blocks(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.BLOCKS, file_format)


def raw_lending_events(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.LENDING_EVENTS, file_format)


def raw_transfers(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.TRANSFERS, file_format)


def raw_positions(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.POSITIONS, file_format)


def raw_prices(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.PRICES, file_format)
