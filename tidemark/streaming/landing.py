"""Landing of raw JSON messages: typed rows to one table, bad records to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming.sinks import BatchWriter

# Deduplication window of each landing table.
DEDUP_WINDOW = {
    "blocks": "600 seconds",
    "lending_events": "600 seconds",
    "transfers": "600 seconds",
    "positions": "600 seconds",
    "prices": "300 seconds",
}
_CORRUPT = "_corrupt_record"


def typed(messages: DataFrame, ddl: str) -> DataFrame:
    """Messages with `r`, the parsed record, and `_corrupt_record`, set where parsing failed or there was no text.

    The broker position travels along as kafka_partition and kafka_offset.
    """
    schema = T.StructType.fromDDL(ddl).add(_CORRUPT, "string")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    value = F.coalesce("value", F.lit(""))
    broken = F.when(F.trim(value) == "", value).otherwise(F.col(f"r.{_CORRUPT}"))
    return messages.withColumn("r", parsed).withColumn(_CORRUPT, broken)


def dedup(messages: DataFrame, within: str) -> DataFrame:
    """Drop redeliveries of a message within a time window.

    A message is known by its broker position, so only true repeats go, even
    where a batch spans more than the window.
    """
    return (
        messages.withColumn("event_time", F.timestamp_millis("timestamp"))
        .withWatermark("event_time", within)
        .dropDuplicatesWithinWatermark(["topic", "partition", "offset"])
        .drop("event_time")
    )


def land(ddl: str, out: str, dead_letters: str) -> BatchWriter:
    """Batch writer: good records to `out`, bad ones with topic and position to `dead_letters`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = typed(batch, ddl).persist()
        try:
            names = [f.name for f in T.StructType.fromDDL(ddl).fields if not f.name.startswith("kafka_")]
            rows.where(F.col(_CORRUPT).isNull()).select(
                *[F.col(f"r.{n}").alias(n) for n in names],
                F.col("partition").alias("kafka_partition"),
                F.col("offset").alias("kafka_offset"),
            ).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            rows.where(F.col(_CORRUPT).isNotNull()).select(
                "topic", "partition", "offset", "key", "value", "timestamp"
            ).write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return write
