"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.llm import ann, decontam, katz, langid, mixing, secrets, simhash, subword, suffixes, toxicity
from tidemark.llm.common import remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, posteriors string, secret_spans string"
LABELS = "doc_id long, quality int, toxic int, text string"


def rows():
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    out = [(None, None), (1, None), (2, ""), (3, "   "), (4, "one two three"), (4, "one two three"), (5, "!!! 123 ---"), (6, long), (7, "Ünïcödé 日本語 текст " * 30), (None, "no id here at all today")]
    return [(i, t, "en" if n % 3 else None, None, None, "s", "f", "p", "x") for n, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0, "t"), (4, 1, 0, "t"), (6, 0, 1, "t"), (7, None, None, None), (None, 1, 1, None), (99, 1, 0, None)], LABELS)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "one two three four five six"), (None, "x"), (2, None), (2, ""), (1, "one two three four five six"), (3, "two words")], "item_id long, text string")


OPERATORS = {
    "op1": lambda docs, labels: toxicity.report(docs, labels),
    "op3": lambda docs, labels: katz.scores(docs),
    "op5": lambda docs, labels: suffixes.remove_repeats(docs),
    "op6": lambda docs, labels: mixing.report(docs, labels),
    "op7": lambda docs, labels: secrets.report(docs),
    "op8": lambda docs, labels: langid.identify(docs, remainder(F.col("doc_id"), 3)),
    "op9": lambda docs, labels: subword.quality(docs, labels),
    "op10": lambda docs, labels: simhash.near_duplicates(docs),
}


def scored(docs, labels, op):
    return OPERATORS[op](docs, labels).collect()


@pytest.mark.parametrize("op", list(OPERATORS))
def test_every_row_gets_a_result(odd, none, labels, no_labels, op):
    got = scored(odd, labels, op)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows())
    for r in got:
        if "score" in r and op in ("op1", "op8", "op9"):
            assert 0 <= r.score <= 1
    assert scored(none, no_labels, op) == []
    if op in ("op1", "op6", "op9"):
        assert len(scored(odd, no_labels, op)) == len(rows())


def test_defined_values(odd, labels):
    assert {r.lang_pred for r in scored(odd, labels, "op8") if r.doc_id in (1, 2, 3, 5)} == {"und"}
    repeats = [r for r in scored(odd, labels, "op5") if r.doc_id in (1, 2)]
    assert all(r.n_bytes == 0 and r.kept_sha256 == hashlib.sha256(b"").hexdigest() for r in repeats)
    assert {r.doc_id: r.n_tokens for r in scored(odd, labels, "op3") if r.doc_id in (1, 2, 3, 4)} == {1: 1, 2: 1, 3: 1, 4: 4}
    found = {r.doc_id: r for r in scored(odd, labels, "op10")}
    assert found[1].fingerprint == found[3].fingerprint == "0" * 16
    assert found[1].component_id == found[3].component_id == 1


def test_search_edges(spark):
    schema = "vec_id long, embedding array<float>, label int, leaf string, v string"
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.0, 2.0]), (None, [1.0, 1.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (9, [1.0, 2.0, 3.0]), (200, [])]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in vectors], schema)
    got = ann.search(df).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0][:3] == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, 2**0.5)]
    assert [r.vec_id for r in got if r.query_id == 100] == [8, 0, 1, 2]
    assert ann.search(df.where("vec_id < 0")).count() == 0
    assert ann.search(df.where("vec_id = 0")).count() == 0


def test_benchmark_edges(odd, none, benchmark):
    assert decontam.leaks(odd, benchmark).count() == 0
    assert decontam.leaks(none, benchmark).count() == 0
    assert decontam.leaks(odd, benchmark.limit(0)).count() == 0
    assert decontam.decontaminated(odd, benchmark).count() == len(rows())


def test_stages_on_odd_and_empty_tables(spark, odd, none, labels, benchmark, tmp_path):
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            got = stage(spark, docs, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert got.columns == docs.columns
            n = got.count()
            assert n == 0 if docs is none else 0 < n <= len(rows())


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([Row(doc_id=3, text=text), Row(doc_id=2, text=text), Row(doc_id=2, text=text), Row(doc_id=9, text="other words that stand alone here")])
    assert sorted(r.doc_id for r in simhash.deduplicated(docs).collect()) == [2, 9]


def test_near_duplicate_stage_decides_by_row(spark):
    """Ids repeated with other texts, groups without an id, and equal rows, in any order."""
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(80)) for k in "abcd")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (None, a, "x"), (None, c, "y"), (None, c, "x"), (None, c, "x"), (3, d, None), (3, d, "z"), (3, d, "z"), (None, None, "x"), (None, "", "x")]
    kept = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string")
        kept.append(sorted(map(str, simhash.deduplicated(docs).collect())))
    assert kept[0] == kept[1] and len(kept[0]) == 5
    got = simhash.deduplicated(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in got if r.text) == [("1", a), ("2", b), ("3", d), ("None", c)]


def test_masking_keeps_the_rest(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    docs = spark.createDataFrame([(1, f"é before {key} after", 5), (2, "clean", 5), (3, 'token = "abcdefgh12"', None)], "doc_id int, text string, n_chars int")
    got = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert got[1].text == "é before [SECRET] after" and got[1].n_chars == 23
    assert got[2].text == "clean" and got[2].n_chars == 5
    assert got[3].text == '[SECRET]"'
