"""Classifiers learn from every labelled row, however few give the first weights."""

import numpy as np

from tidemark.llm import common, subword, toxicity


def test_toxic_words_beyond_the_first_rows_are_learned(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 20)
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('plain words here ', if(id % 2 = 0, concat('vile', char(97 + id % 20)), 'kind')) as text", "'en' as lang")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2 = 0) as toxic")
    network = toxicity.fit(docs, labels).network
    score = lambda word: network.scores(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0]
    clean = score(b"plain words here kind")
    assert all(score(f"plain words here vile{chr(97 + k)}".encode()) > max(0.5, clean) for k in range(0, 20, 2))


def test_all_labelled_rows_are_counted_and_averaged(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('word', id) as text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality")
    seen = []
    monkeypatch.setattr(subword, "averaged", lambda rows, learn, real=common.averaged: seen.append(rows.count()) or real(rows, learn))
    subword.fit(docs, labels, "quality")
    assert seen == [4000]


def test_means_are_weighted_by_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK_ROWS", 30)
    rows = spark.range(100).selectExpr("id as key", "int(id) as label")

    def learn(batches):
        own = [x for b in batches for x in b.column("label").to_pylist()]
        return (len(own), np.array([sum(own) / len(own)] * 70)) if own else None

    assert np.allclose(common.averaged(rows, learn), 49.5, atol=1e-4)
    ones = lambda b: [(1, np.bincount(np.array(b.column("label").to_pylist()) % 3, minlength=3))]
    assert common.counted(rows, ones)[1].tolist() == [34, 33, 33]
    assert common.averaged(rows.where("false"), learn) is None
