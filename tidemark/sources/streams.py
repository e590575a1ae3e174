"""Stream readers: one configuration per topic, one envelope for all topics."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import schemas

# How far out of order each stream may be.
DISORDER = {
    "positions": "30 seconds",
    "prices": "10 seconds",
    "transfers": "30 seconds",
    "messages": "5 seconds",
}


@dataclass(frozen=True)
class StreamConfig:
    """`kafka` needs `topics` and `servers`; file formats need `path`.

    `starting_offsets` is latest, earliest or, as JSON, the first offset of partitions by topic (-2: the earliest there is).
    Message files are a log that several topics may share: there `topics` choose and JSON offsets apply, partitions they
    don't name are read from the start, and latest and earliest both mean all files, which a restart goes on from.
    """

    format: str = "parquet"
    path: str = ""
    topics: tuple[str, ...] = ()
    servers: str = ""
    starting_offsets: str = "latest"
    max_files_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)


def stream_source(spark: SparkSession, config: StreamConfig, ddl: str = schemas.MESSAGES) -> DataFrame:
    reader = spark.readStream.format(config.format)
    if config.format == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", config.servers)
            .option("subscribe", ",".join(config.topics))
            .option("startingOffsets", config.starting_offsets)
        )
        return envelope(reader.options(**config.options).load())
    if config.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", config.max_files_per_trigger)
    rows = reader.schema(ddl).options(**config.options).load(config.path)
    if config.topics:
        rows = rows.where(F.col("topic").isin(*config.topics))
    return from_offsets(rows, json.loads(config.starting_offsets)) if config.starting_offsets.startswith("{") else rows


def from_offsets(messages: DataFrame, first: dict[str, dict[str, int]]) -> DataFrame:
    """The messages at or beyond the first offset of their partition."""
    starts = [(topic, int(partition), offset) for topic, own in first.items() for partition, offset in own.items() if offset >= 0]
    for topic, partition, offset in starts:
        before = (F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") < offset)
        messages = messages.where(~F.coalesce(before, F.lit(False)))
    return messages


def envelope(kafka_rows: DataFrame) -> DataFrame:
    """Broker columns to the message envelope; processing time is read once per batch."""
    return kafka_rows.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("timestamp"),
        F.create_map().cast("map<string,string>").alias("headers"),
        F.unix_millis(F.current_timestamp()).alias("processing_time"),
    )


def read_messages(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Batch reader for stored messages in the same envelope."""
    return spark.read.schema(schemas.MESSAGES).format(file_format).load(path)
