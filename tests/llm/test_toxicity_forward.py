"""The toxicity network against a plain forward pass, word by word, and what training promises."""

import math

import numpy as np
import pytest

from tidemark.llm import toxicity


def trained():
    rng = np.random.default_rng(1)
    rows = []
    for k in range(120):
        words = rng.integers(1, 60, (rng.integers(3, 30), 2)).astype(np.int32)
        if k % 3 == 0:
            words[rng.integers(len(words))] = (99, 98)
        rows.append((int(k % 3 == 0), words, 1.0))
    return toxicity.train(rows), rows


def plain(network, text):
    """The score of one text by loops: embed, slide every filter, take maxima, weigh."""
    x = toxicity.tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    e = [(network.embedding[a].astype(float) + network.embedding[b]) for a, b in x] + [np.zeros(toxicity.EMBEDDING)] * (max(toxicity.WIDTHS) - 1)
    pooled = []
    for width, kernel in zip(toxicity.WIDTHS, network.kernels, strict=True):
        for f in range(toxicity.FILTERS):
            # Filters also begin in the padding: a window of nothing but padding gives 0, which the rectifier gives anyway.
            heights = [sum(float(e[i + j] @ kernel[j, :, f]) for j in range(width) if i + j < len(e)) for i in range(len(e))] if len(x) else []
            pooled.append(max([0.0, *heights]))
    z = sum(h * float(w) for h, w in zip(pooled, network.output, strict=True)) + network.bias
    return 1 / (1 + math.exp(-z))


def test_scores_equal_a_plain_forward_pass():
    network, _ = trained()
    rng = np.random.default_rng(2)
    texts = [b"", b"one", b"one two"] + [" ".join(f"w{i}" for i in rng.integers(0, 40, n)).encode() for n in rng.integers(1, 50, 40)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    assert network.scores(data, offsets) == pytest.approx([plain(network, t) for t in texts], abs=1e-5)


def test_clean_words_cannot_make_up_for_toxic_ones():
    network, rows = trained()
    assert (network.output >= 0).all()
    pooled = lambda x: network.pooled(*toxicity.padded(x, np.array([0, len(x)])))[0] @ network.output
    toxic = next(x for k, x, _ in rows if k)
    clean = next(x for k, x, _ in rows if not k)
    gap = np.zeros((2, 2), np.int32)
    assert pooled(np.concatenate([toxic, gap, clean])) >= pooled(toxic) - 1e-5


def test_thresholds_are_drawn_to_that_of_all():
    network, rows = trained()
    score = lambda x: float(network.pooled(*toxicity.padded(x, np.array([0, len(x)])))[0] @ network.output + network.bias)
    few = [(k, x, "rare" if i < 4 else "common") for i, (k, x, _) in enumerate(rows)]
    cut = toxicity._thresholds(network, few, {0: 1.0, 1: 1.0})
    assert set(cut) == {None, "rare", "common"} and all(0 < v < 1 for v in cut.values())
    assert abs(cut["rare"] - cut[None]) <= 0.2 and np.isfinite(score(rows[0][1]))
    assert toxicity._thresholds(network, [], {}) == {None: 0.5}


def test_documents_without_a_language_are_scored(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").drop("lang")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = toxicity.report(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_repeated_ids_keep_the_sample_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 20)
    docs = spark.range(4000).selectExpr("id % 40 as doc_id", "concat('word', id % 7, ' ', if(id % 40 < 20, 'vile', 'kind')) as text", "'en' as lang")
    labels = spark.range(40).selectExpr("id as doc_id", "int(id < 20) as toxic")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda rows, seed=5, real=toxicity.train: seen.append(len(rows)) or real(rows, seed))
    toxicity.fit(docs, labels)
    assert max(seen) <= 40

