"""Stream sinks on plain files. Each micro-batch owns one `batch_id=` folder, so a
batch that is retried or replayed replaces its own output and nothing else."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.risk import to_alert_json
from tidemark.operators.versions import latest_by

BatchWriter = Callable[[DataFrame, int], None]


def _write_batch(batch: DataFrame, path: str, batch_id: int, file_format: str = "parquet") -> None:
    batch.write.mode("overwrite").format(file_format).save(f"{path}/batch_id={batch_id}")


def upsert_sink(path: str) -> BatchWriter:
    """Append each batch; `read_upserts` resolves the newest row per key."""
    return lambda batch, batch_id: _write_batch(batch, path, batch_id)


def append_sink(path: str) -> BatchWriter:
    return lambda batch, batch_id: _write_batch(batch, path, batch_id)


def alert_sink(path: str = "", kafka: dict[str, str] | None = None) -> BatchWriter:
    """Alerts as key and JSON value, to files or to a broker topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        messages = to_alert_json(batch)
        if kafka:
            messages.write.format("kafka").options(**kafka).save()
        else:
            _write_batch(messages, path, batch_id, "json")

    return write


def read_upserts(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    """The newest row per key; between equal versions the later batch wins."""
    log = spark.read.parquet(path)
    newest = latest_by(log, keys, [F.col(version).desc(), F.col("batch_id").desc()])
    return newest.drop("batch_id")


def read_batches(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).load(path).drop("batch_id")


def compact_upserts(spark: SparkSession, path: str, target: str, keys: list[str], version: str) -> None:
    """Write the resolved table to a new folder, as one batch older than any other."""
    read_upserts(spark, path, keys, version).write.mode("overwrite").parquet(f"{target}/batch_id=-1")


def split_sink(**writers: tuple[Callable[[DataFrame], DataFrame], BatchWriter]) -> BatchWriter:
    """Several outputs of one stream: each selects its rows from the same batch.

    The batch is computed once and kept (memory, then disk) while its outputs
    are written; a lost block is recomputed from the source.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for select, writer in writers.values():
                writer(select(batch), batch_id)
        finally:
            batch.unpersist()

    return write
