"""Benchmark passages in documents: random-walk embedding of item-sized windows, bit-sampling hashes, exact edit distance.

Where simulated leaks of a class of items stay under the target with all walks, its pieces place the items instead: no leak is lost.
Texts are compared as words, in lower case and without punctuation. An item of n words is found where some stretch of a
document is at most 0.2 n word edits (rounded down) away from it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, texts, word_hashes, words

SIMILARITY = 0.8
TARGET_RECALL = 0.98
SEED = 11
#: Words that a table samples from an embedding, tables that share a walk, and walks at most; a class that needs more is searched by pieces.
SAMPLES = 3
TABLES_OF_WALK = 4
MOST_WALKS = 24
#: Items that are held against all documents at a time.
ITEMS = 5_000
#: Lengths of a class of items, the longest over the shortest at most.
CLASS = 1.15
#: Simulated leaks of a class by which walks are calibrated.
TRIALS = 200
PAD = np.uint64(0xFFFFFFFFFFFFFFFF)
_MARK = np.uint64((1 << 20) - 1)


def edits(n: int) -> int:
    return n - math.ceil(n * SIMILARITY - 1e-9)


_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[128:] = np.arange(128, 256)
for _a, _z in ((48, 58), (97, 123)):
    _PLAIN[_a:_z] = np.arange(_a, _z)


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of lower-case texts, and where each text's begin. Punctuation parts words; bytes beyond ASCII are letters."""
    plain = _PLAIN[data]
    starts, ends, _ = words(plain, offsets)
    return word_hashes(plain, starts, ends), np.searchsorted(starts, offsets)


@dataclass(frozen=True)
class Class:
    """Items of like length: `size` words of each are embedded. Without walks, `grams` are the first words of pieces of items, with the item of each and its place there."""

    size: int
    window: int
    seed: int
    grams: np.ndarray
    walks: tuple[tuple[np.ndarray, np.ndarray], ...]
    keys: tuple[np.ndarray, ...]
    owners: tuple[np.ndarray, ...]
    places: np.ndarray


def _walks(size: int, seed: int) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """For each walk an odd multiplier a step, whose product's top bit moves the pointer, and the sampled steps of its tables."""
    rng = np.random.default_rng((seed, size))
    steps = 2 * size
    out = []
    for _ in range(MOST_WALKS):
        factors = rng.integers(0, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        picked = np.sort(np.stack([rng.permutation(steps)[: min(SAMPLES, steps)] for _ in range(TABLES_OF_WALK)]), axis=1)
        out.append((factors, picked))
    return tuple(out)


def embedded_keys(t: np.ndarray, start: np.ndarray, end: np.ndarray, size: int, walk: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(tables, windows): a key of the sampled words of the walk over each window of `size` words that starts at `start` and stops before `end`.

    In each step the pointer stays or moves on, by a random bit of the step and the word under it, so equal stretches
    come into step again behind an edit; behind the window it reads padding.
    """
    factors, picked = walk
    at, stop = start.copy(), np.minimum(start + size, end)
    keys = np.zeros((len(picked), len(start)), np.uint64)
    t = np.append(t, PAD)
    for step in range(int(picked.max()) + 1):
        word = t[np.where(at < stop, at, len(t) - 1)]
        for table in np.flatnonzero((picked == step).any(1)):
            keys[table] = mixed(keys[table] + word)
        at += (word * factors[step] >> np.uint64(63)).astype(np.int64)
    return keys


def _spoiled(item: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """The item after `n` random word edits."""
    out = item.tolist()
    for _ in range(n):
        at, kind, new = int(rng.integers(0, max(1, len(out)))), rng.integers(0, 4), int(rng.integers(2, 1 << 62))
        if kind < 2 and out:
            out[at] = new
        elif kind == 2 and out:
            del out[at]
        else:
            out.insert(at, new)
    return np.array(out, np.uint64)


def grams(t: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place on."""
    h = t[: max(0, len(t) - n + 1)]
    for i in range(1, n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + t[i : len(t) - n + 1 + i]
    return mixed(h)


def _made_class(items: list[np.ndarray], members: list[int]) -> Class:
    sizes = [len(items[i]) for i in members]
    size, longest = min(sizes), max(sizes)
    seed = min(n // (edits(n) + 1) for n in sizes)
    if edits(longest) == 0:
        return _exact_class(items, members, seed)
    walks = _walks(size, SEED)
    rng = np.random.default_rng((SEED, size, 1))
    caught = np.zeros(TRIALS, bool)
    used = 0
    leaks = []
    for i in range(TRIALS):
        item = items[members[i * (len(members) - 1) // (TRIALS - 1)]]
        leaks.append((item, np.concatenate([_spoiled(item, edits(len(item)), rng), rng.integers(2, 1 << 62, size, dtype=np.uint64)])))
    flat = [np.concatenate([x[k] for x in leaks]) for k in (0, 1)]
    begin = [np.cumsum([0, *[len(x[k]) for x in leaks]]) for k in (0, 1)]
    while used < MOST_WALKS and (used == 0 or caught.mean() < TARGET_RECALL):
        a, b = (embedded_keys(flat[k], begin[k][:-1], begin[k][1:], size, walks[used]) for k in (0, 1))
        caught |= (a == b).any(0)
        used += 1
    if caught.mean() < TARGET_RECALL:
        return _exact_class(items, members, seed)
    t = np.concatenate([items[i] for i in members])
    at = np.cumsum([0, *sizes])
    keys, owners = [], []
    for walk in walks[:used]:
        for row in embedded_keys(t, at[:-1], at[1:], size, walk):
            order = np.argsort(row, kind="stable")
            keys.append(row[order])
            owners.append(np.array(members)[order])
    seeds = np.unique(np.concatenate([grams(items[i], seed) for i in members]))
    return Class(size, longest + edits(longest), seed, seeds, walks[:used], tuple(keys), tuple(owners), np.zeros(0, np.int64))


def _exact_class(items: list[np.ndarray], members: list[int], seed: int) -> Class:
    """The class by its pieces alone: of the edits + 1 equal pieces of an item, as many edits leave one unchanged."""
    h, owner, place = [], [], []
    for i in members:
        n = len(items[i])
        at = np.arange(edits(n) + 1) * (n // (edits(n) + 1))
        h.append(grams(items[i], seed)[at])
        owner.append(np.full(len(at), i))
        place.append(at)
    flat = np.concatenate(h)
    order = np.argsort(flat, kind="stable")
    sizes = [len(items[i]) for i in members]
    return Class(min(sizes), max(sizes), seed, flat[order], (), (), (np.concatenate(owner)[order],), np.concatenate(place)[order])


class Matcher:
    """Finds a bounded set of items in texts."""

    def __init__(self, ids: list, items: list[np.ndarray]):
        self.ids, self.items = ids, items
        self.steps = np.array([edits(len(x)) + 1 for x in items], np.int64)
        order = sorted(range(len(items)), key=lambda i: len(items[i]))
        self.classes, group = [], []
        for i in order:
            if group and len(items[i]) > max(CLASS * len(items[group[0]]), len(items[group[0]])):
                self.classes.append(_made_class(items, group))
                group = []
            group.append(i)
        if group:
            self.classes.append(_made_class(items, group))
        # A bit for each seed's low bits: nearly all words of a corpus fail this first test.
        self.marks = {n: np.zeros(1 << 20, bool) for n in {c.seed for c in self.classes}}
        for c in self.classes:
            self.marks[c.seed][c.grams & _MARK] = True

    def find(self, t: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, words up to its end) of the nearest stretch of each item in each text."""
        if not len(t):
            return []
        seeds = {}
        for n, marks in self.marks.items():
            h = grams(t, n)
            place = np.flatnonzero(marks[h & _MARK])
            place = place[np.searchsorted(at, place, "right") == np.searchsorted(at, place + n - 1, "right")]
            seeds[n] = place, h[place]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for c in self.classes:
            # Edits cut an item into edits + 1 pieces at most, so a near window holds a piece unchanged: no window is lost here.
            place, h = seeds[c.seed]
            known = np.isin(h, c.grams)
            place, h = place[known], h[known]
            if not len(place):
                continue
            start, item = self._walked(c, t, at, place) if c.walks else self._aligned(c, at, place, h)
            for i in np.unique(item):
                own = start[item == i]
                far, stop = nearest_stretch(self.items[i], t, own, at, 0 if c.walks else edits(len(self.items[i])))
                text = np.searchsorted(at, own, "right") - 1
                for d, place, doc in zip(far.tolist(), (stop - at[text]).tolist(), text.tolist(), strict=True):
                    if d <= edits(len(self.items[i])):
                        key = doc, int(i)
                        best[key] = min(best.get(key, (d, place)), (d, place))
        return sorted((doc, i, d, place) for (doc, i), (d, place) in best.items())

    def _walked(self, c: Class, t: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, items): windows around the places that share a key of a table with an item."""
        text = np.searchsorted(at, place, "right") - 1
        reach = place[:, None] - np.arange(c.window)
        s = np.unique(reach[reach >= at[text][:, None]])
        e = at[np.searchsorted(at, s, "right")]
        pairs = []
        for w, walk in enumerate(c.walks):
            for table, row in enumerate(embedded_keys(t, s, e, c.size, walk)):
                hit, met = _equal(c.keys[w * TABLES_OF_WALK + table], row)
                pairs.append(hit * len(self.items) + c.owners[w * TABLES_OF_WALK + table][met])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.items))
        return s[window], item

    def _aligned(self, c: Class, at: np.ndarray, place: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, items): where an item begins if its piece is the one at a place, rounded down to steps of its edits + 1."""
        hit, met = _equal(c.grams, h)
        item, first = c.owners[0][met], at[np.searchsorted(at, place, "right") - 1][hit]
        step = self.steps[item]
        start = first + np.maximum(place[hit] - c.places[met] - first, 0) // step * step
        start, item = np.divmod(np.unique(start * len(self.items) + item), len(self.items))
        return start, item


def _equal(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in `row`, places in the sorted `keys`) of every two that are equal."""
    low = np.searchsorted(keys, row, "left")
    n = np.searchsorted(keys, row, "right") - low
    hit = np.repeat(np.arange(len(row)), n)
    return hit, low[hit] + np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)


def nearest_stretch(item: np.ndarray, t: np.ndarray, start: np.ndarray, at: np.ndarray, more: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The least word edit distance between the item and any stretch of the words around each start and the `more` after it (`at`: where texts begin), and where the first such stretch ends.

    Words around a start of which too few are the item's are not compared: they count as the item's length away.
    """
    slack, n = edits(len(item)), len(item)
    text = np.searchsorted(at, start, "right") - 1
    out, stop = np.full(len(start), n, np.int64), start - slack
    width = n + 2 * slack + more + 1
    block = min(4096, max(1, (1 << 20) // width))
    for first in range(0, len(start), block):
        rows = np.arange(first, min(first + block, len(start)))
        place = start[rows, None] - slack + np.arange(width)
        valid = (place >= at[text[rows], None]) & (place < at[text[rows] + 1, None])
        word = np.where(valid, t[np.clip(place, 0, len(t) - 1)], PAD)
        likely = np.isin(word, item).sum(1) >= n - slack
        rows, word = rows[likely], word[likely]
        ramp = np.arange(width + 1)
        d = np.zeros((len(word), width + 1), np.int64)
        for i, w in enumerate(item, 1):
            following = np.empty_like(d)
            following[:, 0] = i
            following[:, 1:] = np.minimum(d[:, 1:] + 1, d[:, :-1] + (word != w))
            d = np.minimum.accumulate(following - ramp, axis=1) + ramp
        out[rows] = d.min(1)
        stop[rows] += d.argmin(1)
    return out, stop


def matchers(benchmark: DataFrame) -> Iterator[Matcher]:
    """The items in blocks of about ITEMS rows; null ids or texts, repeated rows, and items without words take no part; one of up to four words allows no edit."""
    sound = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", lowered(F.col("text")).alias("text")).distinct()
    blocks = math.ceil(sound.count() / ITEMS)
    for block in range(blocks):
        rows = sound.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").toArrow().combine_chunks()
        ids, items = [], []
        for first, _last, data, offsets in texts(rows.column("text")):
            t, at = tokens(data, offsets)
            for i in range(len(offsets) - 1):
                if at[i + 1] > at[i]:
                    ids.append(rows.column("item_id")[first + i].as_py())
                    items.append(t[at[i] : at[i + 1]])
        yield Matcher(ids, items)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, words, ends): every benchmark item found in a document, with the least distance seen.

    `words` is the item's length and `ends` the document's words up to the end of the nearest stretch. Null or
    empty texts hold nothing; repeated documents give repeated rows; a null id is kept. A document or a table without
    finds gives no rows. Other columns are ignored. Every item is held against all whole texts, in blocks of items.
    """
    out = None
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, words int, ends long"
    for matcher in matchers(benchmark):

        def search(batches: Iterator[pa.RecordBatch], matcher: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for first, _last, data, offsets in texts(b.column("lowered")):
                    found = matcher.find(*tokens(data, offsets))
                    if found:
                        doc, item, distance, place = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                b.column("doc_id").take(pa.array([first + d for d in doc])),
                                pa.array([matcher.ids[i] for i in item]),
                                pa.array(distance, pa.int32()),
                                pa.array([len(matcher.items[i]) for i in item], pa.int32()),
                                pa.array(place, pa.int64()),
                            ],
                            names=["doc_id", "item_id", "distance", "words", "ends"],
                        )

        part = docs.select("doc_id", lowered(F.col("text")).alias("lowered")).mapInArrow(search, schema)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with their own columns."""
    own = docs.columns
    for matcher in matchers(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], matcher: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for first, _last, data, offsets in texts(b.column("lowered__")):
                    keep[[first + x[0] for x in matcher.find(*tokens(data, offsets))]] = False
                yield b.select(own).filter(pa.array(keep))

        docs = docs.withColumn("lowered__", lowered(F.col("text"))).mapInArrow(clean, docs.schema)
    return docs
