"""Language identification by hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, texts

DIMENSION = 512
N = 3
#: Letters are folded into this many symbols; symbol 0 is the gap between words.
SYMBOLS = 64
BLOCK = 1 << 19
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """A random vector of ones and minus ones for each symbol."""
    return np.random.default_rng(20).choice(np.array([-1.0, 1.0], np.float32), size=(SYMBOLS, DIMENSION))


LETTERS = _letters()


def bound(codes: np.ndarray) -> np.ndarray:
    """The vectors of n-grams: letter vectors, each rotated by its distance from the end, multiplied."""
    out = np.ones((len(codes), DIMENSION), np.float32)
    for place in range(N):
        symbols = codes // SYMBOLS ** (N - 1 - place) % SYMBOLS
        out *= np.roll(LETTERS, N - 1 - place, axis=1)[symbols]
    return out


def normalised(text: Column) -> Column:
    """Letters in lower case, words framed by single blanks; empty where there is no letter."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))
    return F.when(clean == "", "").otherwise(F.concat(F.lit(" "), clean, F.lit(" ")))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter n-grams of UTF-8 texts, and the index of the text each comes from."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(lead):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    point = data[lead].astype(np.uint64)
    width = np.diff(np.append(lead, len(data)))
    for extra in range(1, 4):
        more = width > extra
        point[more] = point[more] << np.uint64(8) | data[lead[more] + extra]
    symbol = (mixed(point) % np.uint64(SYMBOLS - 27)).astype(np.int64) + 27
    plain = width == 1
    symbol[plain] = np.where(point[plain] == 32, 0, point[plain].astype(np.int64) - 96)
    symbol = np.where((symbol < 0) | (symbol >= SYMBOLS), 0, symbol)
    owner = np.searchsorted(offsets, lead, "right") - 1
    if len(symbol) < N:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(len(symbol) - N + 1, np.int64)
    for place in range(N):
        code = code * SYMBOLS + symbol[place : len(symbol) - N + 1 + place]
    whole = owner[: len(code)] == owner[N - 1 :]
    return code[whole], owner[: len(code)][whole]


def profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    """The sum of the n-gram vectors of all texts of each language, less the mean of all languages' directions.

    Every partition bundles its own texts first; DIMENSION numbers a language reach the driver.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), object)
            for first, last, data, offsets in texts(b.column("clean")):
                code, owner = grams(data, offsets)
                names, which = np.unique(langs[first:last].astype(str), return_inverse=True)
                for i, name in enumerate(names):
                    got, n = np.unique(code[which[owner] == i], return_counts=True)
                    for at in range(0, len(got), 4096):
                        part = n[at : at + 4096].astype(np.float32) @ bound(got[at : at + 4096])
                        sums[name] = sums.get(name, 0.0) + part.astype(np.float64)
        for name, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * DIMENSION, pa.string()), "i": pa.array(range(DIMENSION), pa.int32()), "v": pa.array(np.broadcast_to(v, DIMENSION))})

    known = docs.where(F.col("lang").isNotNull()).select("lang", normalised(F.col("text")).alias("clean")).where("clean <> ''")
    rows = known.mapInArrow(bundle, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v")).collect()
    found: dict[str, np.ndarray] = {}
    for r in rows:
        found.setdefault(r.lang, np.zeros(DIMENSION))[r.i] = r.v
    unit = {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(found.items())}
    centre = np.mean(list(unit.values()), axis=0) if len(unit) > 1 else 0.0
    return {k: v - centre for k, v in unit.items()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """`docs` with `lang_pred` and `score`.

    The prediction is the prototype with the greatest cosine to the text's bundle, ties to the first name; the score is
    (1 + cosine) / 2. A text that is null or has no letter, and any text where nothing was learned, gives `und` and 0.
    All other columns are kept; columns of `docs` named lang_pred or score are replaced. Repeated rows are alike.
    """
    names = list(prototypes)
    unit = np.array([prototypes[k] / (np.linalg.norm(prototypes[k]) or 1.0) for k in names], np.float32).reshape(len(names), DIMENSION)
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, score = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
            for first, last, data, offsets in texts(b.column("clean__"), BLOCK):
                if not names or not len(data):
                    continue
                vectors = _bundles(data, offsets)
                size = np.linalg.norm(vectors, axis=1)
                cosine = (vectors @ unit.T) / np.where(size, size, 1.0)[:, None]
                best = cosine.argmax(1)
                there = np.diff(offsets) > 0
                label[first:last][there] = np.array(names, object)[best[there]]
                score[first:last][there] = np.clip((1 + cosine[np.arange(len(best)), best]) / 2, 0, 1)[there]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [pa.array(label, pa.string()), pa.array(score)], names=[*own, "lang_pred", "score"])

    schema = docs.select(*own).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*own, normalised(F.col("text")).alias("clean__")).mapInArrow(judge, schema)


def _bundles(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of n-gram vectors of each text: counts of the distinct n-grams times their vectors."""
    code, owner = grams(data, offsets)
    distinct, at = np.unique(code, return_inverse=True)
    rows = len(offsets) - 1
    out = np.zeros((rows, DIMENSION), np.float32)
    for first in range(0, len(distinct), 2048):
        last = min(first + 2048, len(distinct))
        inside = (at >= first) & (at < last)
        counts = np.bincount(owner[inside] * (last - first) + at[inside] - first, minlength=rows * (last - first)).astype(np.float32)
        out += counts.reshape(rows, last - first) @ bound(distinct[first:last])
    return out


def identify(docs: DataFrame, remainder: Column) -> DataFrame:
    """Learn from documents whose remainder isn't 1 and predict all: doc_id, held_out, lang_pred, score."""
    held = remainder == 1
    prototypes = profiles(docs.where(~held))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), prototypes).select("doc_id", "held_out", "lang_pred", "score")
