"""Sequential rules over one key's history, cut into time buckets.

A plain `lag` over a key puts the key's whole history into one task. Here
each key is cut into time buckets first: rows look back inside their bucket,
one summary row per bucket looks back over earlier buckets, and the two are
joined. A key with a third of all rows is spread over as many tasks as it has
buckets, and the look-back over summaries is bounded by the covered time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DAY_MS, HOUR_MS


def with_history(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    state: str,
    marker,
    bucket_ms: int = DAY_MS,
) -> DataFrame:
    """Add `prev` (the previous row's `state`) and `mark` (the last marker so far).

    `order` starts with the epoch-millisecond column and must order a key's
    rows totally; rows without it are left out. `state` names a struct column. `marker(prev, current)` gives
    a struct for rows that set a new marker and NULL for rows that keep the
    old one; `prev` is NULL on the first row of a key.
    """
    # Never null: a filter on one side of the join below would keep the sides from being read from one shuffle.
    bucket = F.coalesce(F.floor(F.col(order[0]) / F.lit(bucket_ms)), F.lit(-(1 << 63))).alias("_bucket")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rows = df.select("*", bucket).withColumn("_prev", F.lag(state).over(inside))
    own = F.when(F.col("_prev").isNotNull(), marker(F.col("_prev"), F.col(state)))
    rows = rows.withColumn("_mark", F.last(own, ignorenulls=True).over(inside))

    position = F.struct(*order)
    summary = rows.groupBy(*keys, "_bucket").agg(
        F.min_by(state, position).alias("_first"),
        F.max_by(state, position).alias("_last"),
        F.max_by("_mark", position).alias("_inside"),
    )
    earlier = Window.partitionBy(*keys).orderBy("_bucket")
    summary = summary.withColumn("_before", F.lag("_last").over(earlier))
    summary = summary.withColumn("_opening", marker(F.col("_before"), F.col("_first")))
    carried = F.last(F.coalesce("_inside", "_opening"), ignorenulls=True).over(
        earlier.rowsBetween(Window.unboundedPreceding, -1)
    )
    entering = summary.select(
        *keys, "_bucket", "_before", F.coalesce(F.col("_opening"), carried).alias("_entry_mark")
    )
    return rows.join(entering, [*keys, "_bucket"]).where(F.col(order[0]).isNotNull()).select(
        *[F.col(c) for c in df.columns],
        F.coalesce("_prev", "_before").alias("prev"),
        F.coalesce("_mark", "_entry_mark").alias("mark"),
    )


def _kept(at: np.ndarray, gap: np.ndarray, starts: np.ndarray, last: int) -> tuple[np.ndarray, int]:
    """Which rows are kept, and the time of the last of them. Starts are kept; the others follow from the row kept before.

    Between two starts the fold jumps from one kept row to the next by binary search, once for each spacing that occurs.
    """
    keep, n = starts.copy(), len(at)
    heads = np.unique(np.concatenate([[0], np.flatnonzero(starts)]))
    ends = np.append(heads[1:], n)
    open_rows = ends - heads - starts[heads]
    for first, end in zip(heads[open_rows > 0].tolist(), ends[open_rows > 0].tolist()):
        now = int(at[first]) if starts[first] else last
        rows = np.arange(first + int(starts[first]), end)
        classes = [(int(g), rows[gap[rows] == g]) for g in np.unique(gap[rows])]
        times = [(g, own, at[own]) for g, own in classes]
        while True:
            following = n
            for g, own, when in times:
                k = int(np.searchsorted(when, now + g))
                if k < len(own):
                    following = min(following, int(own[k]))
            if following == n:
                break
            keep[following], now = True, int(at[following])
    return keep, int(at[np.flatnonzero(keep)[-1]]) if keep.any() else last


def keep_spaced(df: DataFrame, keys: list[str], millis: str, spacing: str, tie_break: list[str], bucket_ms: int = DAY_MS) -> DataFrame:
    """Rows that lie at least `spacing` ms after the last kept row of their key.

    Which rows are kept depends on the rows kept before: a fold, not a window function. But a row that lies its own
    spacing or more after the row before it is kept whatever happened earlier, and starts a segment. Segments are found
    by the bucketed look-back of `with_history`, dealt to tasks by key and start, and folded in Arrow batches with one
    number carried along. A busy key is thus folded in as many tasks as it has pauses of a spacing; a stretch without any
    pause stays in one task, in constant memory. Rows without a time are left out, a null spacing counts as 0, and null
    keys are keys. Keys and spacing travel once, inside structs: where `df` has no other columns than those named, rows
    and summary of the look-back have the same columns and are read from one shuffle.
    """
    sound = df.where(F.col(millis).isNotNull()).withColumn(spacing, F.coalesce(spacing, F.lit(0)).cast("long"))
    state = F.struct(F.col(millis).alias("at"), F.col(spacing).alias("gap"))
    rest = [c for c in df.columns if c not in (*keys, spacing)]
    rows = sound.select(F.struct(*keys).alias("_key"), *rest, state.alias("_state"))

    def starts(prev: Column, now: Column) -> Column:
        return F.when(prev.isNull() | (now["at"] - prev["at"] >= now["gap"]), F.struct(now["at"].alias("at")))

    history = with_history(rows, ["_key"], [millis, *tie_break], "_state", starts, bucket_ms)
    start = F.col("prev").isNull() | (F.col(millis) - F.col("prev.at") >= F.col("_state.gap"))
    cut = history.select("_key.*", *rest, F.col("_state.gap").alias(spacing), F.col("mark.at").alias("_segment"), start.alias("_start"))
    names = df.columns
    dealt = cut.repartition(*keys, "_segment").sortWithinPartitions(*keys, "_segment", millis, *tie_break)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = 0
        for batch in batches:
            if batch.num_rows:
                at, gap = batch.column(millis).to_numpy().astype(np.int64), batch.column(spacing).to_numpy()
                keep, last = _kept(at, gap, batch.column("_start").to_numpy(zero_copy_only=False).astype(bool), last)
                yield batch.filter(pa.array(keep)).select(names)

    return dealt.mapInArrow(fold, cut.select(*names).schema)


def running(df: DataFrame, keys: list[str], at: str, sums: list[str], bucket_ms: int = HOUR_MS) -> DataFrame:
    """`df` with each column of `sums` replaced by its total over the key's rows up to the row's own time, equal times included.

    `at` is in epoch milliseconds. A task holds one bucket of a key; what lies before a bucket comes from one row of
    partial sums for each earlier bucket, so a key's longest window is its number of buckets.
    """
    rows = df.withColumn("_bucket", F.floor(F.col(at) / F.lit(bucket_ms)))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    partial = rows.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    before = partial.select(*keys, "_bucket", *[F.sum(f"_{c}").over(earlier).alias(f"_before_{c}") for c in sums])
    upto = rows.withColumns({c: F.sum(c).over(inside) for c in sums})
    whole = upto.join(before, [*keys, "_bucket"])
    totals = {c: F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_before_{c}"), F.lit(0)) for c in sums}
    return whole.withColumns(totals).select(*df.columns)


def latest(df: DataFrame, keys: list[str], at: str, value: str, bucket_ms: int = HOUR_MS) -> DataFrame:
    """`df` with `value` replaced by the key's last value that is not null, at the row's own time or before it.

    Of several values at one time the largest counts. Buckets bound what a task holds, as in `running`.
    """
    timed = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("at"), F.col(value).alias("v")))
    rows = df.withColumns({"_bucket": F.floor(F.col(at) / F.lit(bucket_ms)), "_seen": timed})
    inside = Window.partitionBy(*keys, "_bucket").orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*keys, "_bucket").agg(F.max("_seen").alias("_last"))
    before = before.select(*keys, "_bucket", F.max("_last").over(earlier).alias("_before"))
    upto = rows.withColumn("_seen", F.max("_seen").over(inside)).join(before, [*keys, "_bucket"])
    return upto.withColumn(value, F.coalesce("_seen.v", "_before.v")).select(*df.columns)
