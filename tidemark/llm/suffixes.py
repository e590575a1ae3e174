"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

A window is a string of `LENGTH` bytes. Equal windows hold the same least k-gram, so windows are brought together by it:
a block is a stretch of text whose windows share the k-gram at one place. Equal blocks are counted; the blocks of one
k-gram that differ go into suffix arrays, whose adjacent common prefixes show the windows that they share.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TILE, mixed, runs, stored, utf8

LENGTH = 400
#: Long enough that texts rarely share a k-gram by chance; a power of two.
GRAM = 64
SEPARATOR = 0xFF
#: Different blocks of one k-gram in a suffix array; more are split, and their windows compared across arrays by fingerprint.
SHARD = 1_024
#: Bytes of a suffix array, on average.
BUCKET = 2 << 20
#: Windows of split k-grams in a range of fingerprints, on average.
RANGE = 1 << 20
_LOW = np.uint64((1 << 21) - 1)


def _least_grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window its least k-gram's place (the first of equals), and the hashes of all k-grams."""
    h = data.astype(np.uint64) + np.uint64(1)
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    h = mixed(h)
    least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    span, want = 1, LENGTH - GRAM + 1
    while span < want:
        step = min(span, want - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return (least & _LOW).astype(np.int64), h


def _blocks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Value index, start, length, k-gram hash and content hash of the blocks of a run of values."""
    place, h = _least_grams(data)
    edge = np.zeros(len(data) + 1, np.int64)
    edge[offsets[1:-1]] = 1
    crossed = np.cumsum(edge)
    valid = crossed[: len(place)] == crossed[LENGTH - 1 : LENGTH - 1 + len(place)]
    begin = valid.copy()
    begin[1:] &= (place[1:] != place[:-1]) | ~valid[:-1] | (crossed[1 : len(place)] != crossed[: len(place) - 1])
    starts = np.flatnonzero(begin)
    # A run of windows ends where the next begins, or where windows stop being valid.
    stop = np.flatnonzero(valid & np.append(begin[1:] | ~valid[1:], True))
    size = stop - starts + LENGTH
    raw, digest = data.tobytes(), xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(raw[a : a + n]) for a, n in zip(starts.tolist(), size.tolist(), strict=True)), np.uint64, len(starts))
    return np.searchsorted(offsets, starts, "right") - 1, starts, size, h[place[starts]], content


def _tiles(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first, last value, first, last byte) of pieces of at most TILE bytes; pieces of a long value overlap by a window less one."""
    for first, last in runs(offsets):
        begin, end = int(offsets[first]), int(offsets[last])
        if end - begin <= TILE:
            yield first, last, begin, end
            continue
        while end - begin >= LENGTH:
            yield first, last, begin, min(end, begin + TILE)
            begin += TILE - LENGTH + 1


def _anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = utf8(b.column("text"))
        k1, k2 = (b.column(c).to_numpy() for c in ("k1", "k2"))
        for first, last, begin, end in _tiles(offsets):
            if end - begin < LENGTH:
                continue
            own = np.clip(offsets[first : last + 1], begin, end) - begin
            doc, start, size, gram, content = _blocks(data[begin:end], own)
            yield pa.RecordBatch.from_pydict(
                {
                    "k1": k1[first + doc],
                    "k2": k2[first + doc],
                    "start": start + begin - offsets[first + doc],
                    "size": size.astype(np.int32),
                    "gram": gram.view(np.int64),
                    "content": content.view(np.int64),
                }
            )


def two_stage_sort(t: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The suffixes of `t` in the order of their first `depth` bytes at least.

    Suffixes smaller than their successors are sorted directly. The others follow from scans of the buckets of first
    bytes in ascending order: a suffix larger than its successor comes in its bucket in the order of the successors.
    """
    n = len(t)
    if n == 0:
        return np.zeros(0, np.int64)
    differs = np.append(t[:-1] != t[1:], True)
    turn = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    following = np.append(t[1:], 0).astype(np.int16)
    following[-1] = -1
    smaller = t[turn].astype(np.int16) < following[turn]
    direct = _direct_sort(t, np.flatnonzero(smaller), depth)
    size_a = np.bincount(t[~smaller], minlength=256)
    size_b = np.bincount(t[smaller], minlength=256)
    start = np.concatenate([[0], np.cumsum(size_a + size_b)])
    out = np.empty(n, np.int64)
    fill = start[:-1].copy()
    first_b = np.concatenate([[0], np.cumsum(size_b)])

    def send(source: np.ndarray, above: int) -> None:
        """Put the predecessors that start with a byte over `above` behind what their buckets hold."""
        before = source[source > 0] - 1
        first = t[before]
        before, first = before[first > above], first[first > above]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        counts = np.bincount(first, minlength=256)
        rank = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
        out[fill[first] + rank] = before
        fill[:] += counts

    out[fill[t[-1]]] = n - 1
    fill[t[-1]] += 1
    for c in range(256):
        if size_a[c] + size_b[c] == 0:
            continue
        low = start[c]
        while low < fill[c]:
            high = fill[c]
            source = out[low:high]
            before = source[source > 0] - 1
            same = before[(t[before] == c)]
            out[high : high + len(same)] = same
            fill[c] = high + len(same)
            low = high
        whole = out[start[c] : start[c] + size_a[c]]
        own = direct[first_b[c] : first_b[c + 1]]
        out[start[c] + size_a[c] : start[c + 1]] = own
        send(np.concatenate([whole, own]), c)
    return out


def _eights(t: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one number, zeros behind the end."""
    padded = np.concatenate([t, np.zeros(LENGTH + 16, np.uint8)]).astype(np.uint64)
    out = padded
    for width in (1, 2, 4):
        out = out[:-width] << np.uint64(8 * width) | out[width:]
    return out


def _prefix_hash(t: np.ndarray, factor: int) -> tuple[np.ndarray, np.ndarray]:
    power = np.full(len(t) + 1, factor, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.zeros(len(t) + 1, np.uint64)
    np.cumsum((t.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    inverse = np.full(len(t) + 1, pow(factor, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    return total, np.cumprod(inverse)


def _direct_sort(t: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Sort suffixes by eight bytes a round. Ties whose rest up to `depth` has one fingerprint need no further round."""
    if len(at) < 2:
        return at
    key = _eights(t)
    total, inverse = _prefix_hash(t, 0x9E3779B97F4A7C15)
    end = np.minimum(at + depth, len(t))
    rest = (total[end] - total[at]) * inverse[at]
    order = np.argsort(key[at], kind="stable")
    at, rest = at[order], rest[order]
    out = at.copy()
    first = key[at]
    place = np.arange(len(at))
    group = np.cumsum(np.append(True, first[1:] != first[:-1]))
    for d in range(8, depth + 8, 8):
        # Keep the groups that hold different strings.
        edge = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(edge, len(group)))
        mixed_group = np.minimum.reduceat(rest, edge) != np.maximum.reduceat(rest, edge)
        keep = np.repeat(mixed_group, size)
        at, rest, place, group = at[keep], rest[keep], place[keep], group[keep]
        if not len(at):
            break
        word = key[np.minimum(at + d, len(t) + 8)]
        order = np.lexsort((word, group))
        at, rest, word = at[order], rest[order], word[order]
        out[place] = at
        group = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (word[1:] != word[:-1])))
    return out


def common_prefix_reaches(t: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Whether the suffixes at `a` and `b` share their first `depth` bytes (a multiple of eight)."""
    key = _eights(t)
    alive = np.arange(len(a))
    for d in range(0, depth, 8):
        alive = alive[key[a[alive] + d] == key[b[alive] + d]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def shared_windows(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the blocks: the text they lie in, block, start in the block, whether another window is equal, and its class."""
    size = np.array([len(x) for x in blocks], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    t = np.frombuffer(b"".join(x + bytes([SEPARATOR]) for x in blocks), np.uint8)
    order = two_stage_sort(t)
    owner = np.searchsorted(begin, order, "right") - 1
    inside = order - begin[owner]
    valid = inside <= size[owner] - LENGTH
    order, owner, inside = order[valid], owner[valid], inside[valid]
    equal = common_prefix_reaches(t, order[:-1], order[1:]) if len(order) > 1 else np.zeros(0, bool)
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= equal
    repeated[:-1] |= equal
    classes = np.cumsum(np.append(True, ~equal)) if len(order) else np.zeros(0, np.int64)
    return t, owner, inside, repeated, classes


def _sorted_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Runs (first, last) of windows of a block that are equal to others here; for split k-grams also one window of each class, packed by range of its fingerprint."""
    t, owner, inside, repeated, classes = shared_windows(list(pdf.block))
    gram, content, split = pdf.gram.to_numpy(), pdf.content.to_numpy(), (pdf.different > SHARD).to_numpy()
    by_place = np.lexsort((inside, owner))
    hit = by_place[repeated[by_place]]
    o, s = owner[hit], inside[hit]
    edge = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1))) if len(hit) else np.zeros(0, np.int64)
    last = np.append(edge[1:], len(hit)) - 1 if len(hit) else edge
    # Nullable types: as floats, hashes would lose digits.
    out = pd.DataFrame({"gram": gram[o[edge]], "content": content[o[edge]], "first": s[edge], "last": s[last]}).astype("Int64")
    columns = [*out.columns, "range", "windows"]
    if not split.any() or not len(classes):
        return out.reindex(columns=columns).astype({"range": "Int64", "windows": object})
    one = np.flatnonzero(np.append(True, classes[1:] != classes[:-1]))
    one = one[split[owner[one]]]
    size = pdf.block.map(len).to_numpy()
    at = (np.cumsum(size + 1) - size - 1)[owner[one]] + inside[one]
    prints = [mixed((total[at + LENGTH] - total[at]) * inverse[at]) for total, inverse in (_prefix_hash(t, 0x9E3779B97F4A7C15), _prefix_hash(t, 0xD6E8FEB86659FD93))]
    table = np.stack([prints[0].view(np.int64), prints[1].view(np.int64), gram[owner[one]], content[owner[one]], inside[one], ~repeated[one]])
    ranges = (prints[0] >> np.uint64(32)) * np.uint64(pdf.ranges.iloc[0]) >> np.uint64(32)
    parts = [(int(r), np.ascontiguousarray(table[:, ranges == r]).tobytes()) for r in np.unique(ranges)]
    n = len(out)
    return pd.DataFrame(
        {c: pd.array([*out[c], *[pd.NA] * len(parts)], "Int64") for c in out.columns}
        | {"range": pd.array([*[pd.NA] * n, *[r for r, _ in parts]], "Int64"), "windows": [*[None] * n, *[w for _, w in parts]]}
    )


def _across(pdf: pd.DataFrame) -> pd.DataFrame:
    """Runs of the windows that have no equal in their own array and have one in another; equal windows meet by range of fingerprint."""
    w1, w2, gram, content, start, alone = np.concatenate([np.frombuffer(x, np.int64).reshape(6, -1) for x in pdf.windows], axis=1)
    order = np.lexsort((w2, w1))
    new = np.append(True, (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1]))
    group = np.cumsum(new) - 1
    hit = order[(np.bincount(group)[group] > 1) & (alone[order] == 1)]
    hit = hit[np.lexsort((start[hit], content[hit], gram[hit]))]
    g, c, s = gram[hit], content[hit], start[hit]
    edge = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (s[1:] != s[:-1] + 1))) if len(hit) else np.zeros(0, np.int64)
    last = np.append(edge[1:], len(hit)) - 1 if len(hit) else edge
    return pd.DataFrame({"gram": g[edge], "content": c[edge], "first": s[edge], "last": s[last]})


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(k1, k2, start, end): stretches of a document that lie in repeated windows. k1 and k2 name a document's id and text."""
    keyed = _keyed(docs)
    places = stored(keyed.select("k1", "k2", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(_anchor, "k1 long, k2 long, start long, size int, gram long, content long"), "blocks")
    own = ["gram", "content"]
    kinds = stored(places.groupBy(*own).agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start", "size")).alias("one")), "block-kinds")
    mixed_grams = kinds.groupBy("gram").agg(F.count("*").alias("different")).where("different > 1")
    compared = stored(kinds.join(mixed_grams, "gram").select(*own, "different", "one.*"), "compared-blocks")
    sums = compared.agg(F.sum("size"), F.sum(F.when(F.col("different") > SHARD, F.col("size") - LENGTH + 1))).first()
    total, windows = (x or 0 for x in sums)
    wanted = compared.groupBy("k1", "k2").agg(F.collect_list(F.struct(*own, "different", "start", "size")).alias("parts"))
    # Rows that repeat an id and its text are one text here.
    one_text = keyed.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    cut = one_text.select(F.col("text").cast("binary").alias("bytes"), F.explode("parts").alias("x"))
    blocks = cut.select("x.gram", "x.content", "x.different", F.substring("bytes", F.col("x.start").cast("int") + 1, F.col("x.size")).alias("block"))
    shard = F.pmod(F.col("content"), F.ceil(F.col("different") / SHARD))
    buckets, ranges = max(1, math.ceil(total / BUCKET)), max(1, math.ceil(windows / RANGE))
    dealt = blocks.withColumn("bucket", F.pmod(F.xxhash64("gram", shard), F.lit(buckets))).withColumn("ranges", F.lit(ranges))
    runs_of = "gram long, content long, first long, last long"
    found = stored(dealt.groupBy("bucket").applyInPandas(_sorted_bucket, f"{runs_of}, range long, windows binary"), "shared-windows")
    late = found.where("range is not null").select("range", "windows").groupBy("range").applyInPandas(_across, runs_of)
    known = found.where("range is null").select(*own, "first", "last").unionAll(late)
    whole = kinds.where("n > 1").select(*own, F.lit(0).cast("long").alias("first"), (F.col("one.size") - LENGTH).cast("long").alias("last"))
    of_kind = known.unionAll(whole).groupBy(*own).agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    hit = places.join(of_kind, own).select("k1", "k2", "start", F.explode("runs").alias("r"))
    return hit.select("k1", "k2", (F.col("start") + F.col("r.first")).alias("start"), (F.col("start") + F.col("r.last") + LENGTH).alias("end"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("text", text).withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64("text", F.lit(1)))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, offsets = utf8(b.column("text"))
        n_removed, n_spans, digest = [], [], []
        runs_of = b.column("runs")
        for i in range(b.num_rows):
            own = raw[offsets[i] : offsets[i + 1]]
            kept, removed, spans = own, 0, 0
            if runs_of[i].is_valid and len(runs_of[i].values):
                flat = runs_of[i].values
                depth = np.zeros(len(own) + 1, np.int64)
                np.add.at(depth, flat.field("start").to_numpy(), 1)
                np.add.at(depth, flat.field("end").to_numpy(), -1)
                gone = np.cumsum(depth[:-1]) > 0
                kept, removed = own[~gone], int(gone.sum())
                spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
            n_removed.append(removed)
            n_spans.append(spans)
            digest.append(hashlib.sha256(kept.tobytes()).hexdigest())
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_bytes": np.diff(offsets), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document without the bytes of repeated windows.

    A null text counts as empty; texts shorter than a window keep all. Rows that repeat an id and its text are two
    documents with one text, so all their windows are repeated. Ids may be null or of any type; other columns are ignored.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    by_doc = repeated_runs(docs.select("doc_id", "text")).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    joined = keyed.join(by_doc, ["k1", "k2"], "left").select("doc_id", "text", "runs")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_remove, schema)
