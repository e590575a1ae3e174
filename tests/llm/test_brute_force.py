"""Each registered query against a plain form of its contract on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import decontam, mixing, secrets, simhash, suffixes
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    return {r.doc_id: r.text or "" for r in rows}


def result(spark, small, name):
    return {r.doc_id: r for r in QUERIES[name](spark, small).collect()}


def lowered_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_katz_scores(spark, small, docs):
    texts = {i: [*lowered_words(t), None] for i, t in docs.items()}
    uni, pairs = Counter(), Counter()
    for i, w in texts.items():
        if remainder(i, 10):
            uni.update(w)
            pairs.update(zip(["<", *w[:-1]], w, strict=True))
    n, v = sum(uni.values()), len(uni)

    def good_turing(counts):
        tail = 6 * counts[6] / counts[1]
        share = {r: ((r + 1) * counts[r + 1] / counts[r] / r - tail) / (1 - tail) if counts[r] and tail < 1 else 0 for r in range(1, 6)}
        return {r: s if 0 < s < 1 else (r - 0.5) / r for r, s in share.items()}

    one, two = good_turing(Counter(uni.values())), good_turing(Counter(pairs.values()))
    taken = sum(c * (1 - one.get(c, 1)) for c in uni.values())
    p1 = lambda w: uni[w] * one.get(uni[w], 1) / n if uni[w] else taken / n
    assert sum(map(p1, list(uni))) + p1("never seen") == pytest.approx(1)
    after = defaultdict(dict)
    for (a, b), c in pairs.items():
        after[a][b] = c

    def p(a, b):
        if a not in after:
            return p1(b)
        count, kept = sum(after[a].values()), sum(c * two.get(c, 1) for c in after[a].values())
        below = count + (kept >= count * (1 - 1e-12))
        if b in after[a]:
            return after[a][b] * two.get(after[a][b], 1) / below
        return (1 - kept / below) / (1 - sum(map(p1, after[a]))) * p1(b)

    everything = [*uni, "never seen"]
    for a in list(after)[:3]:
        unseen = p1("never seen") + sum(p1(w) for w in uni if w not in after[a])
        assert sum(p(a, w) for w in everything) == pytest.approx(1) and unseen > 0
    got = result(spark, small, "op3_katz_backoff")
    for i, w in texts.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i, 10) == 0, len(w), sum(uni[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<", *w[:-1]], w, strict=True)), rel=1e-9)


def test_katz_discounts_that_fail_and_full_contexts():
    from tidemark.llm.katz import Discounts, Unigrams

    assert Discounts.good_turing([0.0] * 6).factor.tolist() == [1.0, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9, 1.0]
    nothing = Unigrams.of([0.0] * 8)
    assert nothing.base(np.array([0]))[0] == 0 and nothing.probability(np.array([0]))[0] == 1
    full = Unigrams.of([0.0] * 6 + [2.0, 20.0])
    assert full.probability(np.array([10, 10, 0])).sum() == pytest.approx(1)


def test_nearest_neighbours(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = defaultdict(list)
    for r in QUERIES["op4_nearest_neighbours"](spark, small).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    found = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((x - x[i]) ** 2).sum(1))
        far[i] = np.inf
        near = np.lexsort((ids, far))[:10]
        found += len({v for v, _ in got[ids[i]]} & set(ids[near].tolist()))
        total += 10
        assert [s for _, s in got[ids[i]]] == sorted(s for _, s in got[ids[i]])
        assert all(s == pytest.approx(far[np.flatnonzero(ids == v)[0]], rel=1e-12) for v, s in got[ids[i]])
    assert found / total >= 0.9


def test_two_stage_sort_orders_all_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(150):
        t = rng.integers(65, 65 + int(rng.integers(1, 5)), int(rng.integers(1, 200))).astype(np.uint8)
        raw = t.tobytes()
        assert suffixes.two_stage_sort(t).tolist() == sorted(range(len(t)), key=lambda i: raw[i:])


def removed(texts):
    size = suffixes.LENGTH
    seen = Counter(b[i : i + size] for b in texts for i in range(len(b) - size + 1))
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        yield int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + (gone[:1].sum())), hashlib.sha256(kept).hexdigest()


def test_repeated_strings(spark, small, docs):
    got = result(spark, small, "op5_repeated_strings")
    for i, want in zip(docs, removed([t.encode() for t in docs.values()]), strict=True):
        assert (got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want


def test_repeated_strings_split_between_arrays(spark, monkeypatch):
    """More blocks of one k-gram than an array takes, runs of one byte, and a repeat inside one document."""
    monkeypatch.setattr(suffixes, "SHARD", 2)
    monkeypatch.setattr(suffixes, "BUCKET", 3_000)
    rng = np.random.default_rng(3)
    noise = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = noise(430)
    texts = [noise(int(rng.integers(0, 500))) + passage + noise(int(rng.integers(0, 500))) for _ in range(14)]
    half = noise(500)
    texts += ["a" * 900, "a" * 401, half + noise(50) + half, "é" * 300, noise(399), ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in suffixes.remove_repeats(df).collect()}
    for i, want in enumerate(removed([t.encode() for t in texts])):
        assert (got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want


def test_secrets(spark, small, docs):
    kinds = (("assign", secrets.ASSIGN, 2, 8), ("access", secrets.ACCESS, 0, 16), ("hex", secrets.HEX, 0, 32))
    got = result(spark, small, "op7_secret_scan")
    for i, text in docs.items():
        spans = sorted((m.start(), k, m.end(), name) for k, (name, rx, group, least) in enumerate(kinds) for m in re.finditer(rx, text) if len(m.group(group)) >= least)
        base = ",".join(f"{n}:{a}:{b}" for a, _, b, n in spans)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(base.split(",")) <= set(got[i].spans.split(","))


def test_secrets_by_markov_models(spark):
    rng = np.random.default_rng(5)
    words = ["configuration", "transport_manager", "international", "Responsibilities", "user_authentication_handler", "background-worker-pool"]
    random = lambda n: "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz0123456789"), n))
    rows = [(i, f'see {words[i % 6]}_{words[(i + 1) % 6]} api_key = "{random(32)}" ok') for i in range(600)]
    rows += [(100, f"bare {random(40)} here"), (101, "plain transport_manager_configuration here"), (102, "secret:token:abcdefghij"), (103, None)]
    got = {r.doc_id: r for r in secrets.report(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[100].spans == "markov:5:45" and got[101].spans == "" and got[102].n_assign == 0 and got[103].spans == ""


def test_simhash(spark, small, docs):
    prints = {}
    for i, text in docs.items():
        w = lowered_words(text)
        h = [xxhash.xxh64_intdigest(" ".join(w[j : j + 4]).encode(), 42) for j in range(max(1, len(w) - 3))] if w else []
        prints[i] = sum(1 << bit for bit in range(64) if 2 * sum(x >> bit & 1 for x in h) > len(h))
    got = result(spark, small, "op10_simhash")
    assert all(got[i].fingerprint == f"{x:016x}" for i, x in prints.items())
    check_components({i: got[i].component_id for i in prints}, prints)


def check_components(found, prints):
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert found == {i: root(i) for i in ids}


def test_links_between_chosen_fingerprints(spark, monkeypatch):
    """Pairs 0 to 6 bits apart, chains, and more fingerprints of one value than a cell takes."""
    monkeypatch.setattr(simhash, "PART", 40)
    rng = np.random.default_rng(8)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    for x in list(prints[:20]):
        for n in range(7):
            prints.append(x ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)))
    prints += [prints[0] ^ sum(1 << b for b in range(8) if m >> b & 1) for m in range(200)]
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    groups = {r.fp: r.component_id for r in simhash.groups(df).collect()}
    check_components({i: groups[x] for i, x in enumerate(signed)}, dict(enumerate(prints)))


def test_plan_covers_every_pair():
    sample = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64)
    for total in (100, 200_000, 10_000_000):
        plan = simhash.make_plan(sample, total)
        assert sorted(b for p in plan.partitions for b in p) == list(range(64))
        assert sum(t + 1 for t in plan.thresholds) == 5


def test_leaks(spark, small, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontamination"](spark, small).collect()}
    plain = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())

    def distance(item, text):
        row = np.zeros(len(text) + 1, np.int64)
        ramp = np.arange(len(text) + 1)
        for i, w in enumerate(item, 1):
            step = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + np.array([w != x for x in text], np.int64))])
            row = np.minimum.accumulate(step - ramp) + ramp
        return row.min()

    want = set()
    for d, text in docs.items():
        t = plain(text)
        for k, item in items.items():
            i = plain(item)
            if t and len(set(i) & set(t)) >= 0.5 * len(set(i)) and distance(i, t) <= decontam.edits(len(i)):
                want.add((d, k))
    assert got == want and want


def test_edited_leaks_are_found(spark, small):
    (matcher,) = decontam.matchers(spark.read.parquet(f"{small}/benchmark.parquet"))
    rng = np.random.default_rng(2)
    hits = 0
    for i in range(200):
        k = i % len(matcher.items)
        leak = decontam._spoiled(matcher.items[k], decontam.edits(len(matcher.items[k])), rng)
        text = np.concatenate([rng.integers(2, 1 << 62, 30, dtype=np.uint64), leak, rng.integers(2, 1 << 62, 30, dtype=np.uint64)])
        hits += any(x[1] == k for x in matcher.find(text, np.array([0, len(text)])))
    assert hits >= 190


def test_long_edited_leaks_are_found():
    """As many random edits as the threshold allows, at any place of a text, in items longer than walks can follow."""
    rng = np.random.default_rng(4)
    noise = lambda n: rng.integers(2, 1 << 62, n, dtype=np.uint64)
    items = [noise(n) for n in (200, 210, 400, 410, 800, 900)]
    matcher = decontam.Matcher(list(range(len(items))), items)
    for i in range(60):
        k = i % len(items)
        parts = [noise(int(rng.integers(0, 50))), decontam._spoiled(items[k], decontam.edits(len(items[k])), rng), noise(int(rng.integers(0, 50)))]
        text = np.concatenate([noise(30), *parts])
        found = {x[1]: x[2] for x in matcher.find(text, np.array([0, 30, len(text)]))}
        assert list(found) == [k] and found[k] <= decontam.edits(len(items[k]))


def test_items_of_few_words_are_found(spark):
    """Items of one to four words, as exact runs that no text's end parts."""
    texts = ["so gamma it is", "Alpha, beta! Gamma delta.", "alpha beta", "gamma delta", "alpha beta gamma x delta", "nothing here", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    items = spark.createDataFrame([("a", "gamma"), ("b", "alpha beta"), ("c", "beta gamma delta"), ("d", "alpha beta gamma delta"), ("e", "?!")], "item_id string, text string")
    got = {(r.doc_id, r.item_id, r.distance, r.words, r.ends) for r in decontam.leaks(docs, items).collect()}
    want = {(0, "a", 0, 1, 2), (1, "a", 0, 1, 3), (3, "a", 0, 1, 1), (4, "a", 0, 1, 3), (1, "b", 0, 2, 2), (2, "b", 0, 2, 2), (4, "b", 0, 2, 2), (1, "c", 0, 3, 4), (1, "d", 0, 4, 4)}
    assert got == want
    assert sorted(r.doc_id for r in decontam.decontaminated(docs, items).collect()) == [5, 6]


def test_calibration_spreads_over_the_class(monkeypatch):
    """More members than trials: the longest are simulated too."""
    seen, spoiled = set(), decontam._spoiled
    monkeypatch.setattr(decontam, "_spoiled", lambda item, n, rng: seen.add(len(item)) or spoiled(item, n, rng))
    rng = np.random.default_rng(6)
    decontam.Matcher(list(range(400)), [rng.integers(2, 1 << 62, 100 + i // 40, dtype=np.uint64) for i in range(400)])
    assert seen == set(range(100, 110))


@pytest.mark.parametrize(("name", "label", "least"), [("op1_toxicity", "toxic", 0.9), ("op9_quality", "quality", 0.9)])
def test_held_out_labels(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    got = result(spark, folder, name)
    pairs = [(r[label], got[r.doc_id].predicted) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in pairs) / len(pairs) >= least


def test_languages(spark, small):
    got = result(spark, small, "op8_language_id")
    pairs = [(r.lang, got[r.doc_id].lang_pred) for r in spark.read.parquet(f"{small}/documents.parquet").collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in pairs) / len(pairs) >= 0.97


def test_rates_meet_the_targets(spark, small):
    rows = list(result(spark, small, "op6_mixing").values())
    total = sum(r.tokens for r in rows)
    for domain in mixing.DOMAINS:
        share = sum(r.rate * r.tokens * r[f"p_{domain}"] for r in rows) / total
        assert share == pytest.approx(mixing.TARGETS[domain], abs=1e-4)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)


def test_rates_stay_nonnegative_where_targets_are_out_of_reach(spark):
    rows = [(10, [0.9, 0.1]), (10, [0.5, 0.5]), (10, [0.8, 0.2])]
    df = spark.createDataFrame(rows, "tokens long, posteriors array<double>")
    rates = df.withColumn("rate", mixing.fit_rates(df, [0.0, 1.0]).column()).collect()
    assert all(r.rate >= 0 for r in rates) and rates[1].rate > rates[0].rate


def test_pipeline(spark, small, docs):
    """run() holds what the stages' own results leave, one after the other."""
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    table = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    from tidemark.llm import toxicity

    kept = toxicity.score(table, toxicity.fit(table, labels)).where(~F.col("rejected")).select(*table.columns)
    near = {r.doc_id for r in simhash.near_duplicates(kept).collect() if r.doc_id == r.component_id}
    leaks = {r.doc_id for r in decontam.leaks(kept, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
    assert set(got) <= near - leaks and len(got) >= 0.95 * len(near - leaks)
    for i, r in got.items():
        assert r.rate > 0 and (r.text == docs[i] or "[SECRET]" in r.text)
