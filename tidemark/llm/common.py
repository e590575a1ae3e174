"""Helpers shared by the corpus operators: shared folders, label splits, and words of Arrow text as numpy arrays."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 1 << 20
#: Labelled rows that a task learns from, on average and at once; the number of tasks grows with the rows.
BLOCK_ROWS = 8_192
#: Parts of a model that are averaged apart from each other.
SLICES = 64
_PRIME = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see: below spark.checkpoint.dir, or the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", "") or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a shared folder and read it back: the lineage is cut and the rows survive lost executors."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text by `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and where each value starts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, limit: int = TILE, most: int = 512) -> Iterator[tuple[int, int]]:
    """Ranges of at most `most` values and `limit` bytes together; a longer value stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), first + most, n)
        yield first, last
        first = last


def sampled_labels(labels: DataFrame, label: str, rows: int) -> tuple[DataFrame, dict[int, float]]:
    """Up to `rows` labelled ids of each class in the order of a hash, and the rows of its class that a sampled row stands for."""
    sound = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    total = {r.label: r.n for r in sound.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [sound.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in sorted(total)]
    empty = sound.where(F.lit(False))
    for part in parts:
        empty = empty.unionAll(part)
    return empty, {k: n / min(n, rows) for k, n in total.items()}


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """All rows of `docs` that have a label, with `label`, written to a shared folder.

    Ids and labels (some 12 bytes a row) go to the texts by broadcast, so that no text is shuffled.
    """
    sound = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    return stored(docs.join(F.broadcast(sound), "doc_id"), "labelled")


def blocks(rows: DataFrame) -> DataFrame:
    """All `rows` in as many partitions as have BLOCK_ROWS each on average, or the fewer that they have; nothing is shuffled."""
    return rows.coalesce(max(1, -(-rows.count() // BLOCK_ROWS)))


def counted(rows: DataFrame, count: Callable[[pa.RecordBatch], list[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """Sums over all rows of the arrays that `count` gives for a batch under each number; zeros aren't sent."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for kind, n in count(b):
                total[kind] = total[kind] + n if kind in total else n
        for kind, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"kind": np.full(len(at), kind, np.int32), "at": at.astype(np.int32), "n": n[at].astype(np.int64)})

    got = blocks(rows).mapInArrow(add, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
    kind, at, n = (got.column(c).to_numpy() for c in ("kind", "at", "n"))
    out = {}
    for k in np.unique(kind):
        own = kind == k
        out[int(k)] = np.zeros(at[own].max() + 1, np.int64)
        out[int(k)][at[own]] = n[own]
    return out


def averaged(rows: DataFrame, learn: Callable[[Iterator[pa.RecordBatch]], tuple[int, np.ndarray] | None]) -> np.ndarray | None:
    """The mean of the float arrays that tasks learn from their share of all `rows`, weighted by rows; None without rows.

    `learn` gets a task's rows and gives their number and one flat array. Arrays are cut into
    SLICES and the mean of each is taken by one group, so the driver gets one array, however many tasks there are.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = learn(batches)
        if got is not None:
            parts = [pa.array(a.astype(np.float32)) for a in np.array_split(got[1], SLICES)]
            values = pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)]).astype(np.int32), pa.concat_arrays(parts))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(np.full(SLICES, TaskContext.get().partitionId(), np.int32)), pa.array(np.full(SLICES, got[0], np.int64)), values], names=["slice", "task", "n", "v"])

    def mean(table: pa.Table) -> pa.Table:
        own = table.sort_by("task").combine_chunks()
        n = own.column("n").to_numpy().astype(np.float64)
        total = sum(w * v.values.to_numpy().astype(np.float64) for w, v in zip(n / n.sum(), own.column("v"), strict=True))
        return pa.table({"slice": own.column("slice")[:1], "v": pa.array([total.astype(np.float32)], pa.list_(pa.float32()))})

    got = blocks(rows).mapInArrow(work, "slice int, task int, n long, v array<float>").groupBy("slice").applyInArrow(mean, "slice int, v array<float>").toArrow().sort_by("slice")
    return np.concatenate([v.values.to_numpy() for v in got.column("v")]) if len(got) else None


def texts(column: pa.Array, limit: int = TILE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of values."""
    data, offsets = utf8(column)
    for first, last in runs(offsets, limit):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and value index of every run of bytes that aren't ASCII white space; runs end with their value."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    solid = ~_SPACES[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin, finish = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:n]
    finish[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(offsets, starts, "right") - 1


class _Kept(dict):
    """A cache of one process: it travels empty when the functions of this module are sent to a task."""

    def __reduce__(self):
        return type(self), ()


_POWERS = _Kept()


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least `size` powers of an odd multiplier, and of its inverse, modulo 2^64."""
    standard = size <= TILE + 1
    if standard and "standard" in _POWERS:
        return _POWERS["standard"]
    up = np.full(TILE + 1 if standard else size, _PRIME, np.uint64)
    down = np.full(len(up), pow(_PRIME, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    out = np.cumprod(up), np.cumprod(down)
    if standard:
        _POWERS["standard"] = out
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, by prefix sums of a polynomial; ranges ascend."""
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + TILE, "right")))
        size = int(ends[last - 1] - base)
        up, down = powers(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (total[e] - total[s]) * down[s]
        first = last
    return mixed(out)
