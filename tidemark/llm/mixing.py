"""Mixing to target weights: soft domains of documents, and nonnegative rates whose expected domain tokens meet the targets."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import subword
from tidemark.llm.common import stored, texts, words

DOMAINS = ("prose", "junk")
TARGETS: Mapping[str, float] = {"prose": 0.95, "junk": 0.05}
ROUNDS = 40
#: Largest miss of a domain, in parts of all tokens, at which the rounds end.
TOLERANCE = 1e-6
FEATURES = subword.Settings(widths=(3,))


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the place in DOMAINS that the quality label of a document gives it."""
    domain = F.when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    return labels.select("doc_id", domain.alias("domain"))


def with_domains(docs: DataFrame, model: subword.Model, domains: int) -> DataFrame:
    """`docs` with `posteriors` (a probability for each domain) and `tokens` (words); a null text has no token and the shares of the classes."""
    own = [c for c in docs.columns if c not in ("posteriors", "tokens")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, n = [np.zeros((0, domains))], [np.zeros(0, np.int64)]
            for *_, data, offsets in texts(b.column("text")):
                whole = np.zeros((len(offsets) - 1, domains))
                whole[:, list(model.classes)] = model.posteriors(data, offsets)
                p.append(whole)
                n.append(np.bincount(words(data, offsets)[2], minlength=len(offsets) - 1))
            flat = np.concatenate(p)
            values = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * domains, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [values, pa.array(np.concatenate(n).astype(np.int64))], names=[*own, "posteriors", "tokens"])

    schema = docs.select(*own).schema.add("posteriors", T.ArrayType(T.DoubleType())).add("tokens", "long")
    return docs.select(*own).mapInArrow(judge, schema)


@dataclass(frozen=True)
class Rates:
    """The steps of the descent: the rate of a document is 1, less the product of its posteriors and each step in turn, never under 0."""

    steps: tuple[tuple[float, ...], ...]

    def column(self, posteriors: str = "posteriors") -> Column:
        """All steps applied to the column of posteriors, in order."""
        steps = F.expr("array(" + ",".join("array(" + ",".join(f"{x!r}D" for x in s) + ")" for s in self.steps) + ")") if self.steps else None
        if steps is None:
            return F.lit(1.0)
        taken = lambda step: F.aggregate(F.zip_with(F.col(posteriors), step, lambda p, c: p * c), F.lit(0.0), lambda a, x: a + x)
        return F.aggregate(steps, F.lit(1.0), lambda rate, step: F.greatest(F.lit(0.0), rate - taken(step)))


def fit_rates(weighted: DataFrame, weights: list[float]) -> Rates:
    """Projected-gradient least squares on (tokens, posteriors).

    Rates r minimise (S - T)' M (S - T) over r >= 0, where S sums r * tokens * posteriors, T is the targets' share of all
    tokens, and M is the inverse of the sum of tokens * posteriors * posteriors'. In that measure every step has length
    1. A round is one pass that sums a number for each domain.
    """
    k = len(weights)
    p = [F.element_at("posteriors", i + 1) for i in range(k)]
    sums = [F.coalesce(F.sum(F.col("tokens") * p[i] * p[j]), F.lit(0.0)) for i in range(k) for j in range(k)]
    first = weighted.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), *[s.alias(f"g{i}") for i, s in enumerate(sums)]).first()
    total = float(first.n)
    if total == 0:
        return Rates(())
    gram = np.array(first[1:], np.float64).reshape(k, k)
    inverse = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    share = np.array(weights, np.float64)
    target = total * share / share.sum()
    rates, best, least = Rates(()), Rates(()), float("inf")
    for _ in range(ROUNDS):
        rated = weighted.withColumn("rate", rates.column())
        row = rated.agg(*[F.sum(F.col("rate") * F.col("tokens") * x).alias(f"s{i}") for i, x in enumerate(p)]).first()
        gap = np.array(row, np.float64) - target
        cost = float(gap @ inverse @ gap)
        better, least, best = cost < least * (1 - 1e-6), min(cost, least), rates if cost < least else best
        if not better or np.abs(gap).max() < TOLERANCE * total:
            break
        rates = Rates((*rates.steps, tuple(float(x) for x in inverse @ gap)))
    return best


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, text: bool = True) -> DataFrame:
    """`docs` with `posteriors` (in the order of DOMAINS), `tokens`, `rate` and `copies`.

    The rate is how often a document should be read so that the expected tokens of each domain are its target's share of
    all tokens, as nearly as rates of 0 and more can have it; copies is the rate rounded up or down by a hash of the id,
    so that its mean is the rate. Null and empty texts have no token, hence no influence. Labels of unknown documents
    and null labels teach nothing; without labels all documents are alike and keep rate 1. Repeated rows are alike.
    Columns of `docs` with these four names are replaced. Texts are judged once for the fit and again beside the result,
    so that they need not be stored; without `text` that column is left out, and what is stored for the fit is the result.
    """
    model = subword.fit(docs, labelled_domains(labels), "domain", FEATURES)
    own = [c for c in docs.columns if c not in ("posteriors", "tokens", "rate", "copies")]
    scored = with_domains(docs.select("text") if text else docs.select(*own), model, len(DOMAINS)).drop("text")
    scored = stored(scored, "domains")
    rates = fit_rates(scored, [targets[d] for d in DOMAINS])
    out = (with_domains(docs.select(*own), model, len(DOMAINS)) if text else scored).withColumn("rate", rates.column())
    uniform = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    return out.withColumn("copies", (F.floor("rate") + (uniform < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def report(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """doc_id, tokens, a probability for each domain, rate and copies."""
    out = mixed(docs.select("doc_id", "text"), labels, targets, text=False)
    return out.select("doc_id", "tokens", *[F.element_at("posteriors", i + 1).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", "copies")
