"""How models become tables: view, full table, delete+insert, append; marks and retention.

Tables are plain Parquet folders. Delete+insert comes in two forms:

* the key implies the partition (a daily table): the touched days are
  overwritten and no old row is read;
* the key does not (one row per account): new rows are appended, and `read`
  resolves the newest row per key, like the upsert sinks. `compact` rewrites
  the log when it has grown.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import day_of
from tidemark.operators.versions import latest_by

MODES = ("view", "table", "delete_insert", "append")


@dataclass(frozen=True)
class TableSpec:
    """Where a model is stored and how its rows replace earlier ones."""

    name: str
    mode: str
    unique_key: str | None = None
    version: str | None = None
    partition_by: str | None = None
    high_water: str | None = None
    order_by: tuple[str, ...] = ()
    #: The builder deals its rows by `partition_by` already: few files a day without another shuffle.
    dealt: bool = False
    #: A day has few rows: days are dealt to all tasks, however few bytes they are, since each is a folder to write.
    small_days: bool = False

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode}")
        if self.mode == "delete_insert" and not (self.partition_by or (self.unique_key and self.version)):
            raise ValueError(f"{self.name}: delete+insert needs a partition or a key with a version")


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _load(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def exists(self, spec: TableSpec) -> bool:
        return self._load(spec.name) is not None

    def read(self, spec: TableSpec) -> DataFrame:
        if spec.mode == "view":
            return self.spark.table(spec.name)
        rows = self._load(spec.name)
        if rows is None:
            raise ValueError(f"table {spec.name} has not been built")
        if spec.mode == "delete_insert" and not spec.partition_by:
            # A corrected row may have the version of the row that it replaces: the later build wins.
            built = [F.col(c).desc() for c in ("dbt_updated_at",) if c in rows.columns]
            rest = F.struct(*sorted(set(rows.columns) - {spec.unique_key, spec.version})).desc()
            return latest_by(rows, [spec.unique_key], [F.col(spec.version).desc(), *built, rest])
        return rows

    def mark(self, spec: TableSpec, default=None):
        """The high-water mark as one value. It goes into the next scan as a
        literal, where it prunes partitions and row groups."""
        rows = self._load(spec.name)
        if rows is None or spec.high_water is None:
            return default
        top = rows.agg(F.max(spec.high_water)).first()[0]
        return default if top is None else top

    def materialize(
        self,
        df: DataFrame,
        spec: TableSpec,
        full_refresh: bool = False,
        replace_partitions: bool = False,
    ) -> None:
        """Store `df`. `replace_partitions` makes an append replace the days it covers (a backfill)."""
        if spec.mode == "view":
            df.createOrReplaceTempView(spec.name)
            return
        writer_df = df
        if spec.partition_by and spec.small_days:
            # A fixed number of tasks: adaptive execution would join years of such days in one.
            writer_df = df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), spec.partition_by)
        elif spec.partition_by and not spec.dealt:
            # Rebalancing groups a day's rows into few files and still splits
            # a day that is too large for one task.
            writer_df = df.hint("rebalance", spec.partition_by)
        order = [c for c in (spec.partition_by, *spec.order_by) if c]
        if order:
            writer_df = writer_df.sortWithinPartitions(*order)
        # Hashes and keys are most of a table's bytes, and are texts of few letters.
        writer = writer_df.write.option("compression", "zstd")
        if spec.partition_by:
            writer = writer.partitionBy(spec.partition_by)
        if spec.mode == "table" or full_refresh:
            writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(spec.name))
        elif spec.partition_by and (spec.mode == "delete_insert" or replace_partitions):
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(spec.name))
        else:
            writer.mode("append").parquet(self.path(spec.name))

    def compact(self, spec: TableSpec, target: Warehouse) -> None:
        """Write the resolved rows to another root, to be switched to once complete."""
        target.materialize(self.read(spec), spec, full_refresh=True)

    def retain(self, spec: TableSpec, column: str, days: int, as_of: str | datetime, target: Warehouse) -> None:
        """Copy the rows younger than `days` to another root."""
        target.materialize(apply_retention(self.read(spec), column, days, as_of), spec, full_refresh=True)


    def drop_days(self, spec: TableSpec, days: int, as_of: str | datetime) -> list[date]:
        """Delete the day folders of a daily table that are older than `days`, in place; returns the days that went.

        Only the folder names are read. No row is read or written, and what stays is not touched; a folder whose name is
        no day (rows without one) stays.
        """
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.path(spec.name))
        store = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        oldest, gone = day_of(as_of) - timedelta(days=days), []
        for status in store.listStatus(top) if store.exists(top) else ():
            column, _, value = status.getPath().getName().partition("=")
            try:
                day = date.fromisoformat(value) if status.isDirectory() and column == spec.partition_by else oldest
            except ValueError:
                continue
            if day < oldest:
                store.delete(status.getPath(), True)
                gone.append(day)
        return sorted(gone)


def apply_retention(df: DataFrame, column: str, days: int, as_of: str | datetime) -> DataFrame:
    return df.where(F.to_date(column) >= F.lit(day_of(as_of) - timedelta(days=days)))


def store_failures(failures: DataFrame, path: str) -> None:
    """Keep the failing rows of a check."""
    failures.write.mode("overwrite").parquet(path)
