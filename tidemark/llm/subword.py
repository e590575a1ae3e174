"""Text classifier on averaged vectors of words and character n-grams, with a softmax on top, trained by stochastic gradients."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import averaged, counted, labelled, lower_ascii, mixed, remainder, texts, word_hashes, words

#: Most labelled texts whose features a task holds at once.
HELD_ROWS = 4_096
BUCKETS = 1 << 17
DIMENSION = 8
EPOCHS = 6
RATE = 0.1


@dataclass(frozen=True)
class Settings:
    """Lengths of the character n-grams, and whether letters keep their case."""

    widths: tuple[int, ...] = (3, 4, 5)
    cased: bool = True


@dataclass(frozen=True)
class Model:
    """The trained network folded: as vectors are averaged before a linear layer, each bucket has one number a class."""

    classes: tuple[int, ...]
    logits: np.ndarray
    bias: np.ndarray
    settings: Settings

    def posteriors(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, width = len(offsets) - 1, len(self.classes)
        total, n = np.zeros((rows, width)), np.zeros(rows)
        for index, valid, at in features(data, offsets, self.settings):
            n += np.diff(np.concatenate([[0], np.cumsum(valid)])[at])
            for k in range(1, width):
                value = np.where(valid, self.logits[k][index], 0.0)
                total[:, k] += np.diff(np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])[at])
        z = total / np.maximum(n, 1)[:, None] + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of words, then of word pairs and of each length of n-grams, with a mark of the valid ones and where each text's begin.

    All pairs of one word with itself share a bucket, and all other pairs another. An n-gram may begin or end with the white space around a word, and has none inside.
    """
    data = data if settings.cased else lower_ascii(data)
    starts, ends, owner = words(data, offsets)
    index = (word_hashes(data, starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    first = np.searchsorted(starts, offsets)
    yield index, np.ones(len(index), bool), first
    paired = np.append(False, owner[1:] == owner[:-1])[: len(index)]
    yield np.where(np.append(False, index[1:] == index[:-1])[: len(index)], 0, 1), paired, first
    change = np.zeros(len(data) + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    blank = np.cumsum(change[:-1], dtype=np.int8) == 0
    plain = np.where(blank, np.uint8(32), data).astype(np.uint64)
    inside = np.concatenate([[0], np.cumsum(blank)])
    edge = np.zeros(len(data) + 1, np.int64)
    edge[offsets[1:-1]] = 1
    crossed = np.cumsum(edge)
    for width in settings.widths:
        size = len(data) - width + 1
        if size <= 0:
            continue
        code = plain[:size].copy()
        for j in range(1, width):
            code = code << np.uint64(8) | plain[j : j + size]
        index = (mixed(code + np.uint64(width)) % np.uint64(BUCKETS)).astype(np.int64)
        valid = (inside[width - 1 : width - 1 + size] == inside[1 : 1 + size]) & (crossed[width - 1 : width - 1 + size] == crossed[:size])
        yield index, valid, np.minimum(offsets, size)


def _examples(batch: pa.RecordBatch, settings: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(label, buckets, counts) of each text."""
    label = batch.column("label").to_numpy()
    for first, last, data, offsets in texts(batch.column("text")):
        parts = [(i[v], at, np.concatenate([[0], np.cumsum(v)])) for i, v, at in features(data, offsets, settings)]
        for d in range(last - first):
            f, n = np.unique(np.concatenate([i[c[at[d]] : c[at[d + 1]]] for i, at, c in parts]), return_counts=True)
            yield int(label[first + d]), f.astype(np.intp), n.astype(np.int32)


def _trained(rows: list[tuple[int, np.ndarray, np.ndarray]], share: np.ndarray, seed: int) -> np.ndarray:
    """Stochastic gradients over `rows` (place of the class, buckets, shares of them): the logits of each class, then the bias."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, DIMENSION), np.float32)
    output = rng.normal(0, 1, (DIMENSION, len(share))).astype(np.float32)
    bias = np.log(share / share.sum())
    seen_v, seen_o, seen_b = np.full(BUCKETS, 1e-8), np.full(output.shape, 1e-2), np.full(len(share), 1.0)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            k, f, n = rows[i]
            met = vectors.take(f, axis=0)
            hidden = n @ met
            z = hidden @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[k] -= 1
            back = output @ p
            grad_o = np.outer(hidden, p)
            seen_o += grad_o**2
            seen_b += p**2
            seen = seen_v.take(f) + n**2 * (back @ back) / DIMENSION
            seen_v[f] = seen
            output -= (rate * grad_o / np.sqrt(seen_o)).astype(np.float32)
            bias -= 0.1 * rate * p / np.sqrt(seen_b)
            vectors[f] = met - (rate * n / np.sqrt(seen))[:, None].astype(np.float32) * back.astype(np.float32)
    return np.concatenate([(vectors @ output).T.ravel(), bias])


def fit(docs: DataFrame, labels: DataFrame, label: str, settings: Settings = Settings(), seed: int = 3) -> Model:
    """Learn from all labelled documents: buckets and classes are counted over all of them, and the model is the mean of
    the folded networks that tasks learn from their shares of the rows, at most HELD_ROWS to a network."""
    rows = labelled(docs.select("doc_id", "text"), labels, label).select("label", "text")
    shares = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = tuple(sorted(shares)) or (0, 1)
    if len(classes) == 1:
        classes = tuple(sorted({*classes, 1 - classes[0]}))
    share = np.array([shares.get(c, 0) + 1.0 for c in classes])

    def count(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
        n = np.zeros(BUCKETS, np.int64)
        for _, f, _ in _examples(batch, settings):
            n[f] += 1
        return [(0, n)]

    known = np.zeros(BUCKETS, bool)
    known[np.flatnonzero(counted(rows, count).get(0, np.zeros(0)) > 1)] = True

    def learn(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray] | None:
        held, done, total = [], 0, 0.0
        for b in batches:
            for k, f, n in _examples(b, settings):
                keep = known[f]
                held.append((classes.index(k), f[keep], n[keep] / max(1, n.sum())))
                if len(held) == HELD_ROWS:
                    total, done, held = total + HELD_ROWS * _trained(held, share, seed), done + HELD_ROWS, []
        if held:
            total, done = total + len(held) * _trained(held, share, seed), done + len(held)
        return (done, total / done) if done else None

    flat = averaged(rows, learn)
    flat = np.concatenate([np.zeros(BUCKETS * len(classes)), np.log(share / share.sum())]) if flat is None else flat.astype(np.float64)
    logits, bias = flat[: -len(classes)].reshape(len(classes), BUCKETS), flat[-len(classes) :]
    return Model(classes, np.ascontiguousarray(logits - logits[:1]), bias - bias[0], settings)


def with_posteriors(docs: DataFrame, model: Model, column: str = "posteriors") -> DataFrame:
    """`docs` with an array of the classes' probabilities; a column of that name is replaced. A null text counts as empty and gets the shares of the classes."""
    own = [c for c in docs.columns if c != column]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [model.posteriors(data, offsets) for *_, data, offsets in texts(b.column("text"))]
            flat = np.concatenate(parts) if parts else np.zeros((0, len(model.classes)))
            values = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * len(model.classes), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [values], names=[*own, column])

    return docs.mapInArrow(judge, docs.select(*own).schema.add(column, T.ArrayType(T.DoubleType())))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.3) of every document, learned from labelled ones with crc32(doc_id) mod 5 <> 0.

    Null and empty texts get the share of class 1. Without labels all scores are 0.5. Repeated rows are scored alike,
    labels of unknown documents are ignored, other columns don't matter.
    """
    model = fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0), "quality")
    scored = with_posteriors(docs.select("doc_id", "text"), model)
    score = F.element_at("posteriors", model.classes.index(1) + 1)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))
