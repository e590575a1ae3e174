"""Secret scan: fixed patterns, and random-looking strings found by two character Markov models. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

RUN = r"[A-Za-z0-9+/_=-]"
MIN_RUN = 16
# Ordinary words would make every document a match: the scan for a longer run comes first.
_LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
_LONG_ACCESS = r"AKIA[A-Z0-9]{12,}"
_CANDIDATE = rf"(?<!{RUN}){RUN}{{{MIN_RUN},}}"
SIZE = 128
MARGIN = 5.0
#: Occurrences added to each character, and steps with which a character's own share backs up the steps seen after another.
SMOOTHING, BACKING = 0.5, 66.0
_NONE = "cast(array() as array<struct<start:int,rank:int,end:int,value:string>>)"


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratio of each character step (previous * 128 + next; a step from 0 starts a string) and the threshold."""

    steps: tuple[float, ...]
    threshold: float


def _located(text: Column, pattern: str, rank: int, smallest: int, group: int = 0) -> Column:
    """Matches of `pattern` whose `group` has `smallest` characters: (start, rank, end, value), by code points.

    Positions are running lengths of what lies between the matches and of the matches themselves.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr(_NONE).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["found"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["value"].alias("value"))
        keep = F.coalesce(F.length(x["value"]) >= smallest, F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step)["spans"]).otherwise(F.expr(_NONE))


def base_spans(text: Column) -> Column:
    """Base matches of all three kinds. A run of fewer than 32 hexadecimal digits, or of 16 characters from AKIA on, fails whole, so longer runs alone are sought."""
    return F.concat(
        _located(text, ASSIGN, 0, 8, 2),
        _located(text, _LONG_ACCESS, 1, 16),
        _located(text, _LONG_HEX, 2, 32),
    )


def _candidates(text: Column) -> Column:
    """Runs of 16 or more characters of keys and identifiers with a letter among them."""
    return F.filter(_located(text, _CANDIDATE, 3, MIN_RUN), lambda x: x["value"].rlike("[A-Za-z]"))


def _clear_of(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _code(value: Column, position: Column) -> Column:
    return F.ascii(F.substring(value, position, F.lit(1)))


def train(docs: DataFrame) -> Markov:
    """Character steps of the runs that base patterns mark (random strings) and of the other runs (identifiers), over all documents."""
    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(base_spans(F.col("text")).alias("base"), _candidates(F.col("text")).alias("runs"))
    labelled = found.select("base", F.explode("runs").alias("run")).select(F.col("run.value").alias("value"), (~_clear_of(F.col("run"), F.col("base"))).alias("random"))
    samples = labelled.groupBy("value", "random").count()
    steps = samples.select("random", "count", "value", F.explode(F.sequence(F.lit(1), F.length("value"))).alias("i")).select(
        "random",
        "count",
        F.when(F.col("i") == 1, 0).otherwise(_code(F.col("value"), F.col("i") - 1)).alias("previous"),
        _code(F.col("value"), F.col("i")).alias("next"),
    )
    # At most 2 x 128 x 128 rows.
    counts = {(r.random, r.previous, r.next): float(r.n) for r in steps.groupBy("random", "previous", "next").agg(F.sum("count").alias("n")).collect()}
    return _fitted(counts)


def _fitted(counts: dict[tuple[bool, int, int], float]) -> Markov:
    letters = [i for i in range(SIZE) if chr(i).isalnum() or chr(i) in "+/_=-"]
    rows = {(k, a): sum(counts.get((k, a, b), 0.0) for b in letters) for k in (True, False) for a in [0, *letters]}

    seen = {(k, b): sum(counts.get((k, a, b), 0.0) for a in [0, *letters]) for k in (True, False) for b in letters}
    total = {k: sum(seen[k, b] for b in letters) for k in (True, False)}

    def log_p(kind: bool, a: int, b: int) -> float:
        alone = (seen[kind, b] + SMOOTHING) / (total[kind] + SMOOTHING * len(letters))
        return math.log((counts.get((kind, a, b), 0.0) + BACKING * alone) / (rows[kind, a] + BACKING))

    table = [0.0] * (SIZE * SIZE)
    for a in [0, *letters]:
        for b in letters:
            table[a * SIZE + b] = log_p(True, a, b) - log_p(False, a, b)
    prior = math.log((1 + rows[False, 0]) / (1 + rows[True, 0]))
    return Markov(tuple(table), max(prior, 0.0) + MARGIN)


def _ratio(value: Column, model: Markov) -> Column:
    # A constant that the optimizer folds into one array value.
    table = F.split(F.lit(",".join(map(repr, model.steps))), ",").cast("array<double>")
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last"))

    def step(acc: Column, i: Column) -> Column:
        code = _code(value, i)
        return F.struct((acc["sum"] + F.element_at(table, acc["last"] * SIZE + code + 1)).alias("sum"), code.alias("last"))

    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, step)["sum"]


def scan(docs: DataFrame, model: Markov | None = None) -> DataFrame:
    """`docs` with a column `secret_spans`: array of (start, rank, end, value), ordered by start and kind.

    rank is the place in KINDS; start and end count code points, the end is exclusive; value is the match (for an
    assignment the assigned text). Runs that overlap a base span add none. A null or empty text has no span; a table
    without labelled runs has a model that prefers neither side, which adds none. Repeated rows are scanned alike, all
    other columns are kept; a column of `docs` named secret_spans is replaced.
    """
    model = model or train(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.withColumn("secret_spans", base_spans(text))
    extra = F.filter(_candidates(text), lambda x: _clear_of(x, F.col("secret_spans")) & (_ratio(x["value"], model) > model.threshold))
    return base.withColumn("secret_spans", F.array_sort(F.concat("secret_spans", extra)))


def masked(text: Column, spans: Column) -> Column:
    """`text` with every stretch covered by spans replaced by [SECRET]."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when((x["start"] < acc["at"]) & (acc["at"] > 0), acc["parts"]).otherwise(F.concat(acc["parts"], F.array(gap, F.lit("[SECRET]")))).alias("parts"),
        )

    done = F.aggregate(spans, start, step)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))))


def redact(docs: DataFrame, model: Markov | None = None) -> DataFrame:
    """`docs` with secrets masked in `text`, and `n_chars`, where there is one, set to the new length of changed texts."""
    found = scan(docs, model)
    changed = F.size("secret_spans") > 0
    out = found.withColumn("text", F.when(changed, masked(F.col("text"), F.col("secret_spans"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _digest(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["rank"] + 1), x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of base spans, and all spans as text, per document."""
    spans = F.col("secret_spans")
    of = lambda rank: F.size(F.filter(spans, lambda x: x["rank"] == rank)).cast("long")
    return scan(docs).select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(_digest(F.filter(spans, lambda x: x["rank"] < 3)), 256).alias("base_sha256"),
        _digest(spans).alias("spans"),
    )
