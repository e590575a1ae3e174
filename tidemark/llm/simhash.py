"""Near-duplicates by 64-bit similarity hashes: generalised pigeonhole search and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, stored, texts, words
from tidemark.llm.components import components

BITS = 64
SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Bound of the fingerprints that the driver samples to group bits and to estimate candidates.
SAMPLE = 4_096
#: Fingerprints of one probed value that meet in a task; larger groups are dealt to cells of two parts.
PART = 16_384
#: Cost of a candidate against that of a probe.
CANDIDATE_COST = 0.5


def _fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text: bits set in over half of the hashes of its shingles."""
    rows = len(offsets) - 1
    out = np.zeros(rows, np.uint64)
    data = lower_ascii(data)
    starts, ends, owner = words(data, offsets)
    if not len(starts):
        return out
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1
    joined = np.full(int(at[-1] + size[-1]), 32, np.uint8)
    index = np.repeat(np.arange(len(size)), size)
    joined[np.arange(len(index)) + index] = data[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(len(index))]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    count = np.diff(np.append(first, len(owner)))
    shingles = np.maximum(count - SHINGLE + 1, 1)
    begin = np.repeat(first - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
    last = begin + np.repeat(np.minimum(count, SHINGLE), shingles) - 1
    buffer, digest = joined.tobytes(), xxhash.xxh64_intdigest
    stops = (at[last] + size[last]).tolist()
    hashes = np.fromiter((digest(buffer[a:b], SEED) for a, b in zip(at[begin].tolist(), stops, strict=True)), np.uint64, len(begin))
    edges = np.cumsum(shingles) - shingles
    ones = np.zeros((len(shingles), BITS), np.int64)
    for piece in range(0, len(hashes), 1 << 16):
        part = hashes[piece : piece + (1 << 16)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low, high = np.searchsorted(edges, piece, "right") - 1, np.searchsorted(edges, piece + len(part), "left")
        ones[low:high] += np.add.reduceat(bits, np.maximum(edges[low:high] - piece, 0), axis=0, dtype=np.int64)
    over = 2 * ones > shingles[:, None]
    out[owner[first]] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprint(docs: DataFrame, column: str = "fp") -> DataFrame:
    """`docs` with the fingerprint of `text` as a signed long; a column of that name is replaced.

    A null text counts as empty, and a text without words has fingerprint 0.
    """
    own = [c for c in docs.columns if c != column]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [_fingerprints(data, offsets) for *_, data, offsets in texts(b.column("text"))]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [pa.array(fp.view(np.int64))], names=[*own, column])

    return docs.mapInArrow(extract, docs.select(*own).schema.add(column, "long"))


@dataclass(frozen=True)
class Plan:
    """Bits of each partition, and the most bits in which a partition of a pair may differ to be found there (-1: not probed)."""

    partitions: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]

    def masks(self) -> list[list[int]]:
        """For each probed partition: what is exclusive-ored into a fingerprint to reach the values within its threshold."""
        return [[sum(1 << bit for bit in flips) for n in range(t + 1) for flips in combinations(bits, n)] for bits, t in zip(self.partitions, self.thresholds, strict=True) if t >= 0]

    def covers(self) -> list[int]:
        return [sum(1 << bit for bit in bits) for bits, t in zip(self.partitions, self.thresholds, strict=True) if t >= 0]


def make_plan(sample: np.ndarray, total: int, distance: int = DISTANCE) -> Plan:
    """Partitions of correlated bits, and the thresholds of least estimated cost.

    A pair within `distance` stays within the threshold of some partition if thresholds plus one sum to distance + 1.
    A dynamic program hands out that sum; the cost of a partition is its probes and the candidates that pairs of the
    sample foretell for `total` fingerprints.
    """
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(np.float64)
    spread = bits - bits.mean(0) if len(bits) else bits
    scale = np.sqrt((spread**2).sum(0))
    correlation = np.abs(spread.T @ spread) / np.maximum(np.outer(scale, scale), 1e-9)
    best = None
    for count in range(1, distance + 2):
        partitions = _grouped(correlation, count)
        costs = [_costs(sample, part, total, distance) for part in partitions]
        cost, thresholds = _share_out(costs, distance + 1)
        if best is None or cost < best[0]:
            best = cost, Plan(partitions, thresholds)
    return best[1]


def _grouped(correlation: np.ndarray, count: int) -> tuple[tuple[int, ...], ...]:
    """Equal groups: each starts with the first free bit and takes the bits most correlated with the group."""
    free, out = set(range(BITS)), []
    for i in range(count):
        group = [min(free)]
        free.remove(group[0])
        while len(group) < (BITS * (i + 1)) // count - (BITS * i) // count:
            nxt = max(sorted(free), key=lambda bit: correlation[bit, group].sum())
            group.append(nxt)
            free.remove(nxt)
        out.append(tuple(sorted(group)))
    return tuple(out)


def _costs(sample: np.ndarray, part: tuple[int, ...], total: int, distance: int) -> list[float]:
    """Cost of thresholds -1, 0, 1, ... of a partition."""
    cover = np.uint64(sum(1 << bit for bit in part))
    own, n = sample & cover, len(sample)
    near = np.zeros(distance + 1)
    for at in range(0, n, 512):
        apart = np.bitwise_count(own[at : at + 512, None] ^ own[None, :])
        near += np.bincount(np.minimum(apart, distance + 1).ravel(), minlength=distance + 2)[: distance + 1]
    near[0] -= n
    pairs = max(1, n * (n - 1))
    out, probes = [0.0], 0
    for t in range(distance + 1):
        probes += comb(len(part), t)
        # Independent bits are the least that an unseen value is worth.
        share = max(near[: t + 1].sum() / pairs, probes / 2.0 ** len(part))
        out.append(total * probes + CANDIDATE_COST * share * total * total)
    return out


def _share_out(costs: list[list[float]], units: int) -> tuple[float, tuple[int, ...]]:
    table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for own in costs:
        following: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in table.items():
            for unit, extra in enumerate(own):
                if used + unit <= units:
                    option = (cost + extra, (*chosen, unit - 1))
                    if used + unit not in following or option < following[used + unit]:
                        following[used + unit] = option
        table = following
    return table[units]


def linked(values: np.ndarray, distance: int = DISTANCE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the values as all pairs within `distance` would: a search that drops what it has reached."""
    rest, out = values, []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            close = np.bitwise_count(rest ^ node) <= distance
            if close.any():
                reached, rest = rest[close], rest[~close]
                out.append((np.full(len(reached), node), reached))
                queue.extend(reached)
    return out


def _links_of_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys: short runs by comparing rows that lie s apart, long ones by `linked`."""
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(edge, len(key)))
    u, v = [], []
    short = np.repeat(size <= 16, size)
    own = np.repeat(np.arange(len(size)), size)
    for s in range(1, 16):
        left = np.flatnonzero(short[:-s] & (own[:-s] == own[s:])) if len(own) > s else []
        if not len(left):
            break
        close = np.bitwise_count(fp[left] ^ fp[left + s]) <= DISTANCE
        u.append(fp[left[close]])
        v.append(fp[left[close] + s])
    for at in np.flatnonzero(size > 16):
        for a, b in linked(np.unique(fp[edge[at] : edge[at] + size[at]])):
            u.append(a)
            v.append(b)
    return (np.concatenate(u), np.concatenate(v)) if u else (np.zeros(0, np.uint64),) * 2


def _probe_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the rows of each cell; rows come sorted by cell, and an unfinished cell waits for the next batch."""
    key = fp = np.zeros(0, np.uint64)

    def out(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        u, v = _links_of_runs(k, f)
        return pa.RecordBatch.from_pydict({"u": pa.array(np.minimum(u.view(np.int64), v.view(np.int64))), "v": pa.array(np.maximum(u.view(np.int64), v.view(np.int64)))})

    for b in batches:
        key = np.concatenate([key, b.column("cell").to_numpy().view(np.uint64)])
        fp = np.concatenate([fp, b.column("fp").to_numpy().view(np.uint64)])
        if len(key) and key[0] != key[-1]:
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1
            yield out(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
    if len(key):
        yield out(key, fp)


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v): links that connect distinct fingerprints (column fp) as all pairs within `distance` bits would."""
    distinct = stored(fingerprints.select("fp").distinct(), "fingerprints")
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp", F.lit(9)), "fp").limit(SAMPLE).toPandas()
    plan = make_plan(sample.fp.to_numpy().astype(np.int64).view(np.uint64), total, distance)
    probes = None
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    for i, (cover, masks) in enumerate(zip(plan.covers(), plan.masks(), strict=True)):
        mask = F.explode(F.expr(f"array({','.join(f'{signed(m)}L' if m != 1 << 63 else 'cast(-9223372036854775808 as bigint)' for m in masks)})"))
        own = distinct.select("fp", mask.alias("mask")).select("fp", F.lit(i).alias("i"), F.col("fp").bitwiseXOR(F.col("mask")).bitwiseAND(F.lit(signed(cover))).alias("value"))
        probes = own if probes is None else probes.unionAll(own)
    cells = _dealt_cells(probes)
    ordered = cells.repartition("cell").sortWithinPartitions("cell", "fp")
    return ordered.mapInArrow(_probe_links, "u long, v long")


def _dealt_cells(probes: DataFrame) -> DataFrame:
    """(cell, fp): a probed value is one cell, or, where more than PART fingerprints reach it, a cell for each two of its parts."""
    whole = F.xxhash64("i", "value")
    counts = probes.groupBy("i", "value").agg(F.count("*").alias("n")).where(F.col("n") > PART)
    hot = stored(counts.select("i", "value", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "hot-values")
    if hot.isEmpty():
        return probes.select(whole.alias("cell"), "fp")
    met = probes.join(hot, ["i", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp", F.lit(17)), "parts").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    spread = met.withColumn("part", part).withColumn("other", other)
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return spread.select(F.when(F.col("parts") == 1, whole).otherwise(F.xxhash64("i", "value", low, high)).alias("cell"), "fp")


def _placed(own: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """`own`, a row for each fingerprint, with `root`: the least fingerprint that is reachable over links."""
    roots = components(links(fingerprints))
    return own.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def groups(fingerprinted: DataFrame) -> DataFrame:
    """(fp, component_id): the smallest doc_id that is reachable from each fingerprint over links; ids that are null don't count."""
    placed = _placed(fingerprinted.groupBy("fp").agg(F.min("doc_id").alias("least")), fingerprinted)
    of_root = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(of_root, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document.

    Null and empty texts share fingerprint 0 and so one component; texts of fewer than four words have one shingle.
    Repeated rows each give a row. Where all ids of a component are null, so is its id. An empty table gives no rows.
    """
    fingerprinted = stored(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash")
    found = fingerprinted.join(groups(fingerprinted), "fp")
    return found.select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each group: the one of the smallest id, a null id last, and of rows that share the id the one of the smallest hash.

    Groups are of rows: an id that is repeated with other texts is in the group of each of its texts.
    """
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in docs.columns])
    named = docs.select("*", *[F.xxhash64(F.lit(i), nulls, *docs.columns).alias(f"row{i}__") for i in range(2)])
    keys = ["row0__", "row1__"]
    fingerprinted = stored(with_fingerprint(named.select("doc_id", "text", *keys)).select("doc_id", *keys, "fp"), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *keys)).alias("first")
    kept = _placed(fingerprinted.groupBy("fp").agg(first), fingerprinted).groupBy("root").agg(F.min("first").alias("first"))
    # Equal rows are reduced first, in every input task, so that no task of the join meets all copies of one.
    return named.dropDuplicates(keys).join(kept.select("first.*").select(*keys), keys, "left_semi").select(*docs.columns)
