"""Language-model scores: a Katz backoff bigram model with Good-Turing discounts, counted and applied on blocks of documents.

A block holds the distinct words and word pairs of some documents. It asks the tables of counts, which lie in hash
buckets, once for each distinct entry, so a very frequent word or pair is one row of each block. Words are known by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, mixed, remainder, shared_folder, stored, texts, word_hashes, words

#: Counts above this are trusted.
TRUSTED = 5
#: Tokens of a block, unless a single document has more.
BLOCK = 1 << 20
#: Entries of a bucket of a table, at most.
BUCKET = 2 << 20
END, BEGIN = np.uint64(0), np.uint64(1)
_SALT = np.uint64(0x94D049BB133111EB)


def planes(a: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes first: what varies little compresses well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def unplanes(raw: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw, np.uint64), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Whole numbers of 0 and more, most of them small: a byte each, and eight more for those over 254."""
    small = np.minimum(values, 255).astype(np.uint8)
    return len(values).to_bytes(8, "little") + small.tobytes() + values[small == 255].astype(np.int64).tobytes()


def unpack_small(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    out = np.frombuffer(raw, np.uint8, n, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, np.int64, -1, 8 + n)
    return out


def _bucket_runs(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, last) of sorted keys; a bucket is a range of keys."""
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    edge = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else [], len(keys)).astype(int)
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        yield int(bucket[a]), a, b


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks: ids, training marks and token counts of their documents, the sorted distinct tokens, and each token's place among them."""
    partition, number, held, pending = TaskContext.get().partitionId(), 0, 0, []

    def block() -> pa.RecordBatch:
        ids, train, size, tokens = (list(x) for x in zip(*pending, strict=True))
        vocabulary, place = np.unique(np.concatenate([[END, BEGIN], *tokens]), return_inverse=True)
        ids, train, size = pa.concat_arrays(ids), pa.concat_arrays(train), np.concatenate(size)
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays(
            [pa.array([partition << 32 | number]), pa.array([int(size.sum())]), one(ids), one(train), one(pa.array(size)), pa.array([pack_sorted(vocabulary)], pa.binary()), pa.array([planes(place[2:].astype(np.int32))], pa.binary())],
            names=["block", "tokens", "doc_id", "train", "size", "vocabulary", "places"],
        )

    for b in batches:
        for first, last, data, offsets in texts(b.column("text")):
            data = lower_ascii(data)
            starts, ends, owner = words(data, offsets)
            h = word_hashes(data, starts, ends)
            h = np.where(h < 2, h + np.uint64(2), h)
            size = np.bincount(owner, minlength=last - first) + 1
            tokens = np.full(int(size.sum()), END, np.uint64)
            tokens[np.arange(len(h)) + owner] = h
            pending.append((b.column("doc_id").slice(first, last - first), b.column("train").slice(first, last - first), size.astype(np.int64), tokens))
            held += len(tokens)
            if held >= BLOCK:
                yield block()
                number, held, pending = number + 1, 0, []
    if pending:
        yield block()


@dataclass
class Block:
    """A block's tokens as places in its vocabulary, and its distinct word pairs in the order of their keys."""

    size: np.ndarray
    train: np.ndarray
    vocabulary: np.ndarray
    place: np.ndarray
    before: np.ndarray
    after: np.ndarray
    keys: np.ndarray
    pair: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        vocabulary, place = unpack_sorted(row["vocabulary"]), unplanes(row["places"], np.int32).astype(np.int64)
        size = np.asarray(row["size"], np.int64)
        previous = np.empty_like(place)
        previous[1:] = place[:-1]
        previous[np.cumsum(size) - size] = 1
        distinct, pair = np.unique(previous * len(vocabulary) + place, return_inverse=True)
        before, after = np.divmod(distinct, len(vocabulary))
        keys = mixed(mixed(vocabulary[before] ^ _SALT) + vocabulary[after])
        order = np.argsort(keys, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        return cls(size, np.asarray(row["train"], bool), vocabulary, place, before[order], after[order], keys[order], rank[pair])

    def learned(self) -> np.ndarray:
        """Whether each token is of a training document."""
        return np.repeat(self.train, self.size)


def _requests(buckets: int):
    """(kind, bucket, block, keys, n): the distinct words and pairs of a block with their counts in training documents."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block.read(row)
                learned = block.learned()
                for kind, keys, place in (("word", block.vocabulary, block.place), ("pair", block.keys, block.pair)):
                    n = np.bincount(place[learned], minlength=len(keys))
                    found = [(i, pack_sorted(keys[a:z]), pack_small(n[a:z])) for i, a, z in _bucket_runs(keys, buckets)]
                    bucket, packed, counts = zip(*found, strict=True)
                    yield pa.RecordBatch.from_pydict({"kind": [kind] * len(found), "bucket": pa.array(bucket, pa.int64()), "block": pa.array([row["block"]] * len(found), pa.int64()), "keys": pa.array(packed, pa.binary()), "n": pa.array(counts, pa.binary())})

    return ask


def _tally(pdf: pd.DataFrame) -> pd.DataFrame:
    """The counts of a bucket's entries, sent back to each block in the order of its request.

    The number is twice the count, plus one for the block that speaks for the entry: the first that has it in training.
    A row of block -1 has the number of entries with counts 1, 2, ... TRUSTED + 1, of all counted entries, and their sum.
    """
    pdf = pdf.sort_values("block", kind="stable")
    parts = [unpack_sorted(x) for x in pdf["keys"]]
    keys, n = np.concatenate(parts), np.concatenate([unpack_small(x) for x in pdf.n])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.append(True, keys[1:] != keys[:-1])
    group, count = np.cumsum(new) - 1, np.add.reduceat(n, np.flatnonzero(new))
    speaker = np.flatnonzero(n > 0)
    speaker = speaker[np.append(True, group[speaker][1:] != group[speaker][:-1])] if len(speaker) else speaker
    value = 2 * count[group]
    value[speaker] += 1
    back = np.empty_like(value)
    back[order] = value
    cut = np.cumsum([len(p) for p in parts])[:-1]
    statistics = [float((count == r).sum()) for r in range(1, TRUSTED + 2)] + [float((count > 0).sum()), float(count.sum())]
    kind, bucket = pdf.kind.iloc[0], pdf.bucket.iloc[0]
    out = pd.DataFrame({"kind": kind, "bucket": bucket, "block": pdf.block.to_numpy(), "data": [pack_small(x) for x in np.split(back, cut)]})
    return pd.concat([out.assign(statistics=None), pd.DataFrame({"kind": [kind], "bucket": [bucket], "block": [-1], "data": [b""], "statistics": [statistics]})])


@dataclass(frozen=True)
class Discounts:
    """factor[r]: the share that a count of r keeps (the last: of all larger counts)."""

    factor: np.ndarray

    @classmethod
    def good_turing(cls, counts: list[float]) -> Discounts:
        """counts[r - 1] entries occur r times. Where they give no factor between 0 and 1, half an occurrence is taken off."""
        n = [0.0, *counts]
        tail = (TRUSTED + 1) * n[TRUSTED + 1] / n[1] if n[1] else 1.0
        factor = [1.0]
        for r in range(1, TRUSTED + 1):
            share = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
            factor.append(share if 0 < share < 1 else (r - 0.5) / r)
        return cls(np.array([*factor, 1.0]))

    def kept(self, count: np.ndarray) -> np.ndarray:
        return self.factor[np.minimum(count, TRUSTED + 1)] * count


@dataclass(frozen=True)
class Unigrams:
    """Word probabilities over the known words and one class of all unknown ones; they sum to 1."""

    tokens: float
    distinct: float
    discounts: Discounts
    scale: float
    unknown: float

    @classmethod
    def of(cls, statistics: list[float]) -> Unigrams:
        *counts, distinct, tokens = statistics
        discounts = Discounts.good_turing(counts)
        taken = sum(n * r * (1 - discounts.factor[r]) for r, n in enumerate(counts[:TRUSTED], 1))
        if tokens == 0:
            return cls(0.0, 0.0, discounts, 0.0, 1.0)
        if taken > 0:
            return cls(tokens, distinct, discounts, 1.0, taken / tokens)
        return cls(tokens, distinct, discounts, tokens / (tokens + 1), 1 / (tokens + 1))

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.discounts.kept(count) * self.scale / max(self.tokens, 1.0), self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def _answers(pdf: pd.DataFrame, kind: str) -> np.ndarray:
    own = pdf[pdf.kind == kind].sort_values("bucket")
    return np.concatenate([unpack_small(x) for x in own.data]) if len(own) else np.zeros(0, np.int64)


def _context_counts(words_of_block: np.ndarray) -> np.ndarray:
    """How often each word stands before another: as often as it occurs, the beginning as often as the end."""
    out = words_of_block.copy()
    out[0], out[1] = 0, words_of_block[0]
    return out


def _context_sums(unigrams: Unigrams, pairs: Discounts, buckets: int):
    """For each context of a block: what the entries it speaks for keep of the context's count, and their words' probability."""

    def sums(block_rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block.read(block_rows.iloc[0].to_dict())
        count = _answers(answers, "word") >> 1
        answer = _answers(answers, "pair")
        own = np.flatnonzero(answer & 1)
        width = len(block.vocabulary)
        kept = np.bincount(block.before[own], pairs.kept(answer[own] >> 1), width)
        mass = np.bincount(block.before[own], unigrams.probability(count[block.after[own]]), width)
        context = _context_counts(count)
        known = np.flatnonzero(context > 0)
        keys = block.vocabulary[known]
        rows = [(i, pack_sorted(keys[a:z]), pack_small(context[known[a:z]]), planes(kept[known[a:z]]), planes(mass[known[a:z]])) for i, a, z in _bucket_runs(keys, buckets)]
        return pd.DataFrame(rows, columns=["bucket", "keys", "n", "kept", "mass"]).assign(block=block_rows.block.iloc[0])

    return sums


def _weights(pdf: pd.DataFrame) -> pd.DataFrame:
    """The backoff weight of each context, sent back to each block; negative where the context's count is raised by one.

    That is done where no count was discounted, which would leave nothing for unseen words. The weight is what seen
    words leave, over the probability that the unigrams give to all other words, so that each context sums to 1.
    """
    parts = [unpack_sorted(x) for x in pdf["keys"]]
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    edge, group = np.flatnonzero(new), np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    total = lambda column: np.add.reduceat(np.concatenate([unplanes(x, np.float64) for x in pdf[column]])[order], edge)
    kept, mass = total("kept"), total("mass")
    count = np.concatenate([unpack_small(x) for x in pdf.n])[order][edge].astype(np.float64)
    full = kept >= count * (1 - 1e-12)
    weight = (1 - kept / np.where(full, count + 1, count)) / np.maximum(1 - mass, 1e-300)
    weight = np.where(full, -weight, weight)[group]
    cut = np.cumsum([len(p) for p in parts])[:-1]
    return pd.DataFrame({"kind": "context", "bucket": pdf.bucket.iloc[0], "block": pdf.block.to_numpy(), "data": [x.tobytes() for x in np.split(weight, cut)]})


def _scored(unigrams: Unigrams, pairs: Discounts):
    def score(block_rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = block_rows.iloc[0].to_dict()
        block = Block.read(row)
        count = _answers(answers, "word") >> 1
        seen = _answers(answers, "pair") >> 1
        context = _context_counts(count)
        weight = np.ones(len(context))
        own = answers[answers.kind == "context"].sort_values("bucket")
        if len(own):
            weight[context > 0] = np.concatenate([np.frombuffer(x, np.float64) for x in own.data])
        below = (context + (weight < 0))[block.before]
        backed_off = np.abs(weight)[block.before] * unigrams.probability(count)[block.after]
        p = np.where(seen > 0, pairs.kept(seen) / np.maximum(below, 1), backed_off)
        begin = np.cumsum(block.size) - block.size
        tokens = count[block.place]
        return pd.DataFrame(
            {
                "doc_id": list(row["doc_id"]),
                "held_out": ~block.train,
                "n_tokens": block.size,
                "n_known": np.add.reduceat((tokens > 0).astype(np.int64), begin),
                "train_tokens": int(unigrams.tokens),
                "base_score": np.add.reduceat(unigrams.base(count)[block.place], begin),
                "score": np.add.reduceat(np.log10(p)[block.pair], begin),
            }
        )

    return score


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability) of every document.

    Counts are of documents with crc32(doc_id) mod 10 <> 0. A null text counts as empty and has one token, the end.
    Unknown words are one class, which holds the Good-Turing mass of words seen once. Without training documents every
    probability is 1. Rows may repeat, ids may be null (held out); other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", "text", (remainder(F.col("doc_id"), 10) != 0).alias("train"))
    made = cut.mapInArrow(_blocks, f"block long, tokens long, doc_id array<{kind}>, train array<boolean>, size array<long>, vocabulary binary, places binary")
    blocks = _bucketed(made)
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(1, math.ceil(tokens / BUCKET))
    asked = blocks.mapInArrow(_requests(buckets), "kind string, bucket long, block long, keys binary, n binary")
    answers = stored(asked.groupBy("kind", "bucket").applyInPandas(_tally, "kind string, bucket long, block long, data binary, statistics array<double>"), "ngram-counts")
    size = TRUSTED + 3
    total = answers.where("block = -1").groupBy("kind").agg(F.array(*[F.sum(F.element_at("statistics", i + 1)) for i in range(size)]).alias("s")).collect()
    statistics = {r.kind: list(r.s) for r in total}
    unigrams = Unigrams.of(statistics.get("word", [0.0] * size))
    pairs = Discounts.good_turing(statistics.get("pair", [0.0] * size)[: TRUSTED + 1])
    counted = answers.where("block >= 0").select("kind", "bucket", "block", "data")
    sums = blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(_context_sums(unigrams, pairs, buckets), "bucket long, keys binary, n binary, kept binary, mass binary, block long")
    weights = stored(sums.groupBy("bucket").applyInPandas(_weights, "kind string, bucket long, block long, data binary"), "backoff-weights")
    everything = counted.unionAll(weights)
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(everything.groupBy("block")).applyInPandas(_scored(unigrams, pairs), out)


def _bucketed(blocks: DataFrame) -> DataFrame:
    """Write the blocks bucketed, so that they stay in place when answers come to them."""
    spark = blocks.sparkSession
    folder = shared_folder(spark, "blocks")
    name = "blocks_" + folder.rsplit("-", 1)[1]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(parts, "block").sortBy("block").option("path", folder).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)
