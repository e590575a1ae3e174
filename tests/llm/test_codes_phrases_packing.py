"""Vector codes, collocations and packing against plain forms, and on odd inputs."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import codes, collocations, packing
from tidemark.llm.queries import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
ODD = "doc_id long, text string, lang string, n string, f string, item string"


def odd_rows():
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    texts = [(None, None), (1, None), (2, ""), (3, "   \n "), (4, "one two three"), (4, "one two three"), (5, "!!! 123 ---"), (6, long), (7, "Ünïcödé 日本語\x1c текст  \t x " * 30), (8, "a<|endoftext|>b c")]
    return [(i, t, "en" if n % 3 else None, "n", "f", "i") for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


# --- vector codes ---------------------------------------------------------------


def plain_codes(vectors, ids, labels, parts=16, entries=64, rounds=2):
    x = [np.floor(np.array(v, np.float64) * 256).astype(int).reshape(parts, -1) for v in vectors]
    order = sorted(range(len(x)), key=lambda i: ids[i])[:entries]
    books = [[x[i][p].tolist() for i in order] for p in range(parts)]

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(v[p].tolist(), books[p][e])), e)) for p in range(parts)] for v in x]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [x[i][p].tolist() for i in range(len(x)) if got[i][p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    got = assign()
    error = [sum((a - b) ** 2 for p in range(parts) for a, b in zip(x[i][p].tolist(), books[p][got[i][p]])) for i in range(len(x))]
    by_label = defaultdict(int)
    for label, e in zip(labels, error):
        by_label[label] += e
    return {i: ("".join(f"{c:02x}" for c in g), e, by_label[label]) for i, g, e, label in zip(ids, got, error, labels)}


@pytest.mark.parametrize("kind", ["random", "grid", "few", "equal"])
def test_vector_codes(spark, kind):
    rng = np.random.default_rng(5)
    n = {"few": 20}.get(kind, 150)
    v = rng.normal(size=(n, 32)) * 0.1
    if kind == "grid":  # many ties
        v = rng.integers(-1, 2, size=(n, 32)) / 4
    if kind == "equal":
        v = np.repeat(v[:3], 50, axis=0)
    labels = [None if i % 7 == 0 else i % 3 for i in range(n)]
    ids = [int(i) for i in rng.permutation(n) * 3]
    frame = spark.createDataFrame([(i, r.tolist(), k, "x") for i, r, k in zip(ids, v, labels)], "vec_id long, embedding array<double>, label int, code string")
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in codes.compress(frame.repartition(3)).collect()}
    assert got == plain_codes(v.tolist(), ids, labels)


def test_rings_lose_no_candidate():
    rng = np.random.default_rng(2)
    for spread in (3, 40, 1000):
        entries = rng.integers(-spread, spread, size=(64, 4))
        x = rng.integers(-spread, spread, size=(3000, 4))
        own = rng.integers(0, 64, size=3000)
        far = np.zeros(64, np.int64)
        np.maximum.at(far, own, ((x - entries[own]) ** 2).sum(1))
        assert (codes.reassign(x, own, entries, *codes.neighbours(entries, far)) == codes.nearest(x, entries)).all()


def test_stable_core_is_not_compared():
    entries = np.array([[0, 0], [100, 0]])
    others, gaps = codes.neighbours(entries, np.array([20, 20]))
    assert others.shape[1] == 0
    assert codes.reassign(np.array([[1, 1]]), np.array([0]), entries, others, gaps).tolist() == [0]


def test_bad_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.1] * 16), (1, None), (2, [nan] * 16), (3, [inf] + [0.0] * 15), (4, [None] + [0.0] * 15), (6, [0.1] * 8), (None, [0.2] * 16), (5, [0.1] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = codes.compress(frame).collect()
    assert sorted(str(r.vec_id) for r in got) == ["5", "5", "None"]
    assert {r.label_error for r in got} == {0}
    assert codes.compress(frame.where("vec_id = 1")).collect() == []
    assert codes.compress(frame.limit(0)).collect() == []
    assert [r.code for r in codes.compress(spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>")).collect()] == ["00" * 16]


def test_decoded_vectors_have_the_stated_error(spark, small):
    frame = spark.read.parquet(f"{small}/embeddings.parquet")
    rows, books = codes.fit(frame)
    told = {r.vec_id: r.error for r in codes.compress(frame).collect()}
    for r in rows.collect():
        x = np.floor(np.array(r.vector, np.float64) * 256).astype(np.int64)
        back = books.decode(np.frombuffer(r.code, np.uint8)[None].astype(int))[0]
        assert int(((x - back) ** 2).sum()) == told[r.vec_id]


# --- collocations ---------------------------------------------------------------


def plain_phrases(rows, least, share, top):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        kept, found = [p for p in f if len(p) > 1 and f[p] >= least], []
        longest = Counter()
        for p in kept:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longest[q] = max(longest[q], f[p])
        for p in kept:
            if len(p) == 2 and longest[p] and 100 * longest[p] >= share * f[p]:
                continue
            score, k = min((1_000_000 * f[p] * f[p] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("seed", "least", "share", "top"), [(1, 2, 50, 2000), (2, 3, 90, 40), (3, 1, 100, 7)])
def test_collocations(spark, monkeypatch, seed, least, share, top):
    rng = np.random.default_rng(seed)
    vocabulary = ["a", "B", "ab", "é", "日本", "z", "a'b", "00", "\x00", "\x85"]
    gaps = [" ", " ", " ", "\t", ". ", "\n", "  ", "?!"]

    def text(words):
        return "".join(vocabulary[min(int(rng.exponential(2)), 9)] + gaps[rng.integers(len(gaps))] for _ in range(words))

    rows = [(text(rng.integers(0, 60)), ["en", "de", None][rng.integers(3)]) for _ in range(200)] + [(None, "en"), ("", None), (text(3000), "de")]
    monkeypatch.setattr(collocations, "BLOCK", 300)  # the long text is counted in parts
    frame = spark.createDataFrame([(i, t, k, "n") for i, (t, k) in enumerate(rows)], "doc_id long, text string, lang string, n string").repartition(5)
    got = sorted(tuple(r) for r in collocations.mine(frame, least, top, share).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == plain_phrases(rows, least, share, top)


def test_streams_cut_within_one_first_word(spark):
    """A first word and a pair that span several tasks still hand on their counts, and take the largest extension."""
    words = [(("the", "", ""), 9_000), (("the", "x", ""), 5_000)] + [(("the", "x", f"w{i:04}"), i + 1) for i in range(400)] + [((f"w{i:04}", "", ""), i + 1) for i in range(400)]
    frame = spark.createDataFrame([("en", *w, f) for w, f in words], "lang string, w1 string, w2 string, w3 string, f long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = collocations.merged(frame, ["w1", "w2", "w3"], ["c1", "c2", "ext"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(words)
    for r in got:
        assert r.c1 == (9_000 if r.w1 == "the" and r.w2 else None)
        assert r.c2 == (5_000 if r.w3 else None)
        assert r.ext == (400 if r.w2 and not r.w3 else None)


def test_scores_pass_64_bits(spark):
    a, left, right = 10**15, 3 * 10**15, 7 * 10**15 + 1
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(collocations._score(row.a, row.l, row.r).alias("s")).first().s == 10**6 * a * a // (left * right)


def test_odd_texts_have_phrases_or_none(odd, none):
    assert collocations.mine(none).collect() == []
    got = collocations.mine(odd, least=1, top=None).collect()
    assert {r.n for r in got if r.lang == "en"} == {sum(len(t.replace("!", " ").split()) for _, t, lang, *_ in odd_rows() if t and lang and "\x1c" not in t) + sum(len(re.findall("[^ \t]+", t)) for _, t, lang, *_ in odd_rows() if t and lang and "\x1c" in t)}


# --- packing --------------------------------------------------------------------


def check_packed(rows, texts, capacity):
    """All the contract's rules; returns the number of sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    wanted = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            wanted[doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    found = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], packing.CAPACITY)
    assert found <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1


def test_packing_by_rounds(spark, monkeypatch):
    """Blocks of some thirty pieces, so that rounds do the work."""
    monkeypatch.setattr(packing, "BLOCK", 32)
    monkeypatch.setattr(packing, "SLACK", 1)
    rng = np.random.default_rng(3)
    sizes = [int(s) for s in rng.integers(1, 90, 1500)] + [60] * 300
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "item long, length long")
    rows = packing.packed(frame, 100).collect()
    assert sorted(r.length for r in rows) == sorted(sizes)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1].tolist()]
        assert sum(n for _, n in parts) <= 100
    whole = len(packing.best_fit(np.array(sizes), 100)[2])
    assert len(places) <= whole * 1.05
    fills = sorted(sum(n for _, n in p) for p in places.values())
    assert fills[0] + fills[1] > 99


def test_odd_texts_are_packed(spark, odd, none):
    check_packed(packing.pack(odd, PATH, capacity=64).collect(), [r[:2] for r in odd_rows()], 64)
    assert packing.pack(none, PATH).collect() == []
    whole = packing.sequences(odd, PATH, capacity=64).collect()
    assert all(len(r.ids) <= 64 for r in whole)
    tokenizer = Tokenizer.from_file(PATH)
    assert sum(len(r.ids) for r in whole) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in odd_rows())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_in_parts_have_the_ids_of_the_whole(name):
    path = public_tokenizers.path(name)
    encode, tokenizer = packing.encoder(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(4)
    alphabet = list("ab1'.,  \n\t") + ["é", "日", "\xa0", "\x85", "\x1c", " ", "'s", " the", "<|endoftext|>", "🙂", "­"]
    for _ in range(500):
        text = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.best_fit(np.array([60, 50, 40, 50, 35]), 100)
    assert fills.tolist() == [100, 100, 35] and offsets.tolist() == [0, 0, 60, 50, 0]
    assert pa.array(bins).to_pylist() == [0, 1, 0, 1, 2]
