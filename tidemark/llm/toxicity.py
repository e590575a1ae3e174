"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy, with thresholds by language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import averaged, counted, labelled, remainder, sampled_labels, texts, word_hashes, words

#: Bound, for each class, of the labelled rows that give the network its first weights, and half of what a task trains on at once.
TRAIN_ROWS = 2_000
BUCKETS = 1 << 16
EMBEDDING = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Bytes of a word that its second embedding is hashed from.
STEM = 4
EPOCHS = 5
RATE = 0.02
#: Passes over all labelled rows after that, and the part of the rate they go on with.
ROUNDS = 2
LATER_RATE = 0.3
#: Steps of a log-odds that scores are counted by for thresholds, and the log-odds where they end.
STEPS, FAR = 256, 16
#: Share of a text's words that a training step leaves out, so that no text is known by one word alone.
LEFT_OUT = 0.2
#: How much more than its share a toxic text weighs in training.
TOXIC_WEIGHT = 2.0
#: One in so many training rows calibrates thresholds and is kept from the network that they are calibrated on.
CALIBRATION = 5
#: Labelled texts of the rarer class at which a language's own threshold weighs as much as that of all languages.
PRIOR = 20
BLOCK = 1 << 19


def normalised(text: Column) -> Column:
    """Runs of letters in lower case, with single blanks between them."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its first bytes (inflected forms share them), and where each text's words begin.

    Bucket 0 is kept for padding and for what is rare.
    """
    starts, ends, _ = words(data, offsets)
    whole = word_hashes(data, starts, ends)
    stem = word_hashes(data, starts, np.minimum(ends, starts + STEM)) ^ np.uint64(1 << 40)
    both = np.stack([whole, stem], 1) % np.uint64(BUCKETS - 1)
    return both.astype(np.int32) + 1, np.searchsorted(starts, offsets)


@dataclass
class Network:
    """embedding: (BUCKETS, EMBEDDING); kernels[i]: (width, EMBEDDING, FILTERS); output: one weight a filter, then the bias."""

    embedding: np.ndarray
    kernels: list[np.ndarray]
    output: np.ndarray
    bias: float

    def pooled(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The maximum of every filter over each text, 0 at least. Each text ends with padding as wide as the widest filter."""
        rows = len(at) - 1
        out = np.zeros((rows, FILTERS * len(WIDTHS)), np.float32)
        there = np.flatnonzero(np.diff(at) > 0)
        if not len(there):
            return out
        e = self.embedding[x[:, 0]] + self.embedding[x[:, 1]]
        for i, (width, kernel) in enumerate(zip(WIDTHS, self.kernels, strict=True)):
            z = e @ kernel[0]
            for j in range(1, width):
                z[: len(z) - j] += e[j:] @ kernel[j]
            out[there, i * FILTERS : (i + 1) * FILTERS] = np.maximum.reduceat(z, at[:-1][there], axis=0)
        return np.maximum(out, 0)

    def copy(self) -> Network:
        return Network(self.embedding.copy(), [k.copy() for k in self.kernels], self.output.copy(), self.bias)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.embedding.ravel(), *[k.ravel() for k in self.kernels], self.output, [np.float32(self.bias)]]).astype(np.float32)

    def filled(self, flat: np.ndarray) -> Network:
        """A network of this one's shapes with the numbers of `flat`."""
        shapes = [self.embedding.shape, *[k.shape for k in self.kernels], self.output.shape]
        ends = np.cumsum([np.prod(s) for s in shapes])
        parts = [flat[e - np.prod(s) : e].reshape(s).astype(np.float32) for e, s in zip(ends, shapes, strict=True)]
        return Network(parts[0], parts[1:-1], parts[-1], float(flat[-1]))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, at = padded(*tokens(data, offsets))
        z = self.pooled(x, at) @ self.output + self.bias
        return 1 / (1 + np.exp(-z.astype(np.float64)))


def padded(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the padding of the widest filter behind every text, so that no filter looks into the next one."""
    gap = max(WIDTHS) - 1
    rows = len(at) - 1
    out = np.zeros((len(x) + gap * rows, 2), np.int32)
    owner = np.repeat(np.arange(rows), np.diff(at))
    out[np.arange(len(x)) + owner * gap] = x
    return out, at + np.arange(rows + 1) * gap


@dataclass(frozen=True)
class Counts:
    """Of each bucket, the texts and the toxic texts that have it; and the number of both."""

    seen: np.ndarray
    toxic: np.ndarray
    rows: int
    positive: int

    @classmethod
    def of(cls, rows: list[tuple[int, np.ndarray, float]]) -> Counts:
        seen, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for k, x, *_ in rows:
            u = np.unique(x)
            seen[u] += 1
            toxic[u] += k
        return cls(seen, toxic, len(rows), sum(k for k, *_ in rows))


def fresh(counts: Counts, rng: np.random.Generator) -> Network:
    odds = np.log((counts.toxic + 0.5) / (counts.positive + 1)) - np.log((counts.seen - counts.toxic + 0.5) / (counts.rows - counts.positive + 1))
    embedding = rng.normal(0, 0.1, (BUCKETS, EMBEDDING)).astype(np.float32)
    # The first coordinate starts from how the word splits the texts; rare words carry nothing.
    embedding[:, 0] = np.clip(odds, -3, 3) * np.minimum(1, counts.seen / 10)
    embedding[counts.seen < 2] = 0
    kernels = [rng.normal(0, 0.2, (width, EMBEDDING, FILTERS)).astype(np.float32) for width in WIDTHS]
    for kernel in kernels:
        kernel[0, 0] = np.abs(kernel[0, 0])
    return Network(embedding, kernels, np.abs(rng.normal(0, 0.2, FILTERS * len(WIDTHS))).astype(np.float32), -1.0)


def _widened(network: Network, known: Counts, counts: Counts, seed: int = 5) -> Network:
    """`network` with the words that `counts` has beyond those it knows, each as it starts in a fresh network."""
    rest = fresh(counts, np.random.default_rng(seed)).embedding
    out = network.copy()
    new = known.seen < 2
    out.embedding[new] = rest[new]
    out.embedding[0] = 0
    return out


def train(rows: list[tuple[int, np.ndarray, float]], seed: int = 5) -> Network:
    """A new network from `rows` (label, buckets, weight)."""
    counts = Counts.of(rows)
    rng = np.random.default_rng(seed)
    return descend(fresh(counts, rng), rows, counts.seen, rng, [RATE * (1 - epoch / EPOCHS) for epoch in range(EPOCHS)])


def descend(network: Network, rows: list[tuple[int, np.ndarray, float]], seen: np.ndarray, rng: np.random.Generator, rates: list[float]) -> Network:
    """`network` after an epoch for each of `rates`: Adam on the weighted log loss; words of a single text share bucket 0.

    Output weights are kept from falling below 0: a filter can find toxic words but clean words cannot make up for them.
    """
    net = network.copy()
    embedding, kernels = net.embedding, net.kernels
    state = [np.zeros_like(a) for a in (*kernels, net.output)], [np.zeros_like(a) for a in (*kernels, net.output)]
    first, second, bias_state, step = np.zeros_like(embedding), np.zeros_like(embedding), np.zeros(2), 0
    mean = sum(w for *_, w in rows) / max(1, len(rows))
    for rate in rates:
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), 16):
            step += 1
            grads = [np.zeros_like(a) for a in (*kernels, net.output)]
            g_bias, g_words, g_values = 0.0, [], []
            batch = order[begin : begin + 16]
            for i in batch:
                k, x, w = rows[i]
                x = np.where(seen[x] < 2, 0, x)
                x = np.where(rng.random((len(x), 1)) < LEFT_OUT, 0, x)
                x = np.concatenate([x, np.zeros((max(WIDTHS) - 1, 2), x.dtype)])
                e = net.embedding[x].sum(1)
                best, height = [], []
                for width, kernel in zip(WIDTHS, kernels, strict=True):
                    z = sum(e[j : len(e) - max(WIDTHS) + 1 + j] @ kernel[j] for j in range(width))
                    at = z.argmax(0) if len(z) else np.zeros(FILTERS, int)
                    best.append(at)
                    height.append(z[at, np.arange(FILTERS)] if len(z) else np.zeros(FILTERS))
                h = np.maximum(np.concatenate(height), 0)
                p = 1 / (1 + np.exp(-(h @ net.output + net.bias)))
                g = (p - k) * w / mean / len(batch)
                grads[-1] += g * h
                g_bias += g
                back = np.where(h > 0, g * net.output, 0)
                for n, (width, kernel) in enumerate(zip(WIDTHS, kernels, strict=True)):
                    own = back[n * FILTERS : (n + 1) * FILTERS]
                    for j in range(width if len(x) >= max(WIDTHS) else 0):
                        grads[n][j] += e[best[n] + j].T * own
                        g_words += [x[best[n] + j, 0], x[best[n] + j, 1]]
                        g_values += [own[:, None] * kernel[j].T] * 2
            for n, (a, g) in enumerate(zip((*kernels, net.output), grads, strict=True)):
                a -= _adam(state[0][n], state[1][n], g, rate, step)
            np.maximum(net.output, 0, out=net.output)
            bias_state[0] = 0.9 * bias_state[0] + 0.1 * g_bias
            bias_state[1] = 0.999 * bias_state[1] + 0.001 * g_bias**2
            net.bias -= rate * bias_state[0] / (1 - 0.9**step) / (np.sqrt(bias_state[1] / (1 - 0.999**step)) + 1e-8)
            if g_words:
                u, inverse = np.unique(np.concatenate(g_words), return_inverse=True)
                g = np.zeros((len(u), EMBEDDING), np.float32)
                np.add.at(g, inverse, np.concatenate(g_values))
                g[u == 0] = 0
                m, v = first[u], second[u]
                net.embedding[u] -= _adam(m, v, g, rate, step)
                first[u], second[u] = m, v
    net.embedding[0] = 0
    return net


def _adam(m: np.ndarray, v: np.ndarray, g: np.ndarray, rate: float, step: int) -> np.ndarray:
    m *= 0.9
    m += 0.1 * g
    v *= 0.999
    v += 0.001 * g * g
    return rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


@dataclass(frozen=True)
class Model:
    """A network, and the score from which a text of a language is toxic (None: any other language)."""

    network: Network
    thresholds: dict[str | None, float]


def _weight(label: int, weight: float = 1.0) -> float:
    return weight * (TOXIC_WEIGHT if label else 1.0)


def _examples(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(label, buckets, apart) of each text."""
    label, apart = batch.column("label").to_pylist(), batch.column("apart").to_pylist()
    for first, last, data, offsets in texts(batch.column("clean")):
        x, at = tokens(data, offsets)
        for i in range(last - first):
            yield label[first + i], x[at[i] : at[i + 1]], apart[first + i]


def _counts(rows: DataFrame) -> dict[bool, Counts]:
    """Counts of all rows (True), and of those that don't calibrate (False)."""

    def count(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
        n = np.zeros((2, 2, BUCKETS + 1), np.int64)
        for k, x, apart in _examples(batch):
            n[int(apart), int(k), np.unique(x)] += 1
            n[int(apart), int(k), BUCKETS] += 1
        return [(2 * a + k, n[a, k]) for a in (0, 1) for k in (0, 1)]

    got = counted(rows, count)
    n = np.zeros((2, 2, BUCKETS + 1))
    for kind, values in got.items():
        n[kind // 2, kind % 2, : len(values)] = values
    make = lambda own: Counts(own.sum(0)[:BUCKETS], own[1, :BUCKETS], int(own[:, BUCKETS].sum()), int(own[1, BUCKETS]))
    return {True: make(n.sum(0)), False: make(n[0])}


def _first_rows(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[int, np.ndarray, bool]], dict[int, float]]:
    """The rows of the first weights. Ids that repeat in `docs` don't raise their bound of twice TRAIN_ROWS."""
    chosen, weight = sampled_labels(labels, "toxic", TRAIN_ROWS)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, data, offsets in texts(b.column("clean")):
                x, at = tokens(data, offsets)
                own = [b.column(c)[first:last] for c in ("label", "apart")]
                yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays((2 * at).astype(np.int32), pa.array(x.ravel()))], names=["label", "apart", "x"])

    picked = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id").select("label", "apart", "clean")
    got = picked.mapInArrow(extract, "label int, apart boolean, x array<int>").orderBy(F.xxhash64("x", "label")).limit(2 * TRAIN_ROWS).toArrow()
    rows = []
    for b in got.to_batches():
        x = b.column("x")
        rows += [(k, x[i].values.to_numpy().reshape(-1, 2), a) for i, (k, a) in enumerate(zip(b.column("label").to_pylist(), b.column("apart").to_pylist(), strict=True))]
    return sorted(rows, key=lambda r: (r[0], r[2], len(r[1]), r[1].tobytes())), weight


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from all labelled documents. Languages set thresholds only; the score never sees them.

    Words are counted over all of them. Two networks get their first weights from a bounded number of rows; then, in each
    round, every task goes on from the mean of all tasks' networks with its own share of all rows. One of them leaves out
    one row in CALIBRATION, all of which calibrate the thresholds; the other one has learned from all and scores.
    """
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    apart = remainder(F.concat(F.lit("apart"), F.col("doc_id").cast("string")), CALIBRATION) == 0
    rows = labelled(docs.select("doc_id", language.alias("lang"), apart.alias("apart"), normalised(F.col("text")).alias("clean")), labels, "toxic")
    first, weight = _first_rows(rows, labels)
    counts = _counts(rows)
    networks = {}
    for whole in (True, False):
        own = [(k, x, _weight(k, weight[k])) for k, x, a in first if whole or not a]
        networks[whole] = _widened(train(own), Counts.of(own), counts[whole])
    size = networks[True].flat().size
    for turn in range(ROUNDS if first else 0):
        rate = RATE * LATER_RATE * (1 - turn / ROUNDS)

        def learn(batches: Iterator[pa.RecordBatch], start: dict[bool, Network] = networks, rate: float = rate, turn: int = turn) -> tuple[int, np.ndarray] | None:
            own, held, done = dict(start), [], 0

            def step() -> None:
                for whole in own:
                    got = [(k, x, _weight(k)) for k, x, a in held if whole or not a]
                    own[whole] = descend(own[whole], got, counts[whole].seen, np.random.default_rng(7 + turn), [rate])

            for b in batches:
                for row in _examples(b):
                    held.append(row)
                    if len(held) == 2 * TRAIN_ROWS:
                        step()
                        done, held = done + len(held), []
            if held:
                step()
            done += len(held)
            return (done, np.concatenate([own[True].flat(), own[False].flat()])) if done else None

        flat = averaged(rows, learn)
        networks = {whole: networks[whole].filled(part) for whole, part in ((True, flat[:size]), (False, flat[size:]))}
    return Model(networks[True], _calibrated(rows.where("apart"), networks[False]))


def _calibrated(rows: DataFrame, network: Network) -> dict[str | None, float]:
    """Thresholds from the scores of all `rows`, which are counted by language, label and step of the log-odds."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [network.scores(data, offsets) for *_, data, offsets in texts(b.column("clean"), BLOCK)]
            s = np.clip(np.concatenate(parts) if parts else np.zeros(0), 1e-9, 1 - 1e-9)
            z = np.clip(np.log(s / (1 - s)), -FAR, FAR)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("label"), pa.array(np.round(z * STEPS).astype(np.int32))], names=["lang", "label", "step"])

    found = rows.mapInArrow(judge, "lang string, label int, step int").groupBy("lang", "label", "step").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "step", "label").collect()
    score = 1 / (1 + np.exp(-np.array([r.step for r in found], np.float64) / STEPS))
    number = np.array([r.n for r in found], np.float64)
    return _cuts(score, np.array([r.label for r in found], int), number, number, [r.lang for r in found])


def _thresholds(network: Network, rows: list[tuple[int, np.ndarray, str | None]], weight: dict[int, float]) -> dict[str | None, float]:
    """The thresholds of rows that are at hand."""
    at = np.concatenate([[0], np.cumsum([len(x) for _, x, _ in rows])]).astype(np.int64)
    score = np.zeros(len(rows))
    for first in range(0, len(rows), 256):
        last = min(first + 256, len(rows))
        own = np.concatenate([x for _, x, _ in rows[first:last]])
        z = network.pooled(*padded(own, at[first : last + 1] - at[first])) @ network.output + network.bias
        score[first:last] = 1 / (1 + np.exp(-z.astype(np.float64)))
    label, w = np.array([k for k, *_ in rows], int), np.array([weight[k] for k, *_ in rows])
    return _cuts(score, label, w, np.ones(len(rows)), [r[2] for r in rows])


def _cuts(score: np.ndarray, label: np.ndarray, w: np.ndarray, number: np.ndarray, langs: list[str | None]) -> dict[str | None, float]:
    """The score that errs least on each language's texts, half way between the scores beside it; the middle one of equals.

    In log odds, a language's threshold is drawn to that of all, and that one to 1/2, the more the fewer texts of its
    rarer class there are.
    """

    def drawn(own: np.ndarray, to: float) -> float:
        n = min(number[own & (label == 1)].sum(), number[own & (label == 0)].sum())
        cut = np.clip(_cut(score[own], label[own], w[own]), 1e-6, 1 - 1e-6)
        return float((n * np.log(cut / (1 - cut)) + PRIOR * to) / (n + PRIOR))

    whole = drawn(np.ones(len(score), bool), 0.0)
    odds = {None: whole} | {lang: drawn(np.array([own == lang for own in langs]), whole) for lang in sorted({own for own in langs if own is not None})}
    return {lang: float(1 / (1 + np.exp(-z))) for lang, z in odds.items()}


def _cut(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    if not len(score) or label.min() == label.max():
        return 0.5
    order = np.argsort(score, kind="stable")
    s, sign = score[order], np.where(label[order] == 1, weight[order], -weight[order])
    # Errors when the first i scores are called clean, beyond those when none is.
    error = np.concatenate([[0.0], np.cumsum(sign)])
    possible = np.concatenate([[True], s[1:] > s[:-1], [True]])
    error[~possible] = np.inf
    best = np.flatnonzero(error <= error.min() + 1e-9)
    edges = np.concatenate([[0.0], s, [1.0]])
    cuts = (edges[best] + edges[best + 1]) / 2
    return float(cuts[np.abs(cuts - 0.5).argmin()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score` (0 to 1), `threshold` of the document's language, and `rejected` (score at or over it).

    A null or empty text gets the score of no evidence. An unknown or null language has the threshold of all. Columns of
    `docs` with these three names are replaced; the others are kept. Repeated rows are scored alike.
    """
    own = [c for c in docs.columns if c not in ("score", "threshold", "rejected")]
    network, limits = model.network, model.thresholds

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [network.scores(data, offsets) for *_, data, offsets in texts(b.column("clean__"), BLOCK)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=[*own, "score"])

    scored = docs.select(*own, normalised(F.col("text")).alias("clean__")).mapInArrow(judge, docs.select(*own).schema.add("score", "double"))
    limit = F.lit(limits[None])
    if "lang" in own:
        for lang, cut in limits.items():
            if lang is not None:
                limit = F.when(F.col("lang") == lang, cut).otherwise(limit)
    return scored.withColumn("threshold", limit).withColumn("rejected", F.col("score") >= F.col("threshold"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5), threshold and rejected, learned from labelled documents with crc32(doc_id) mod 5 <> 0."""
    model = fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return score(docs.select("doc_id", "text", *(c for c in ("lang",) if c in docs.columns)), model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "rejected",
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't rejected, with their own columns."""
    kept = score(docs, fit(docs, labels)).where(~F.col("rejected"))
    return kept.select(*docs.columns)
