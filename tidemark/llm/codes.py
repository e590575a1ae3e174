"""Compressed vectors: each part of a vector becomes the index of its nearest codebook entry, found by ball k-means.

An entry's ball holds the parts assigned to it. Its radius says which other entries can be nearer to any of its parts
(its neighbours); a part that lies within half the gap to the nearest neighbour is in the stable core and is not compared
at all; a part beyond it lies in one of the rings between half-gaps and is compared with that many neighbours only. All
of it is integer arithmetic on squared distances, so the rings lose no candidate and ties go to the smaller index.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components go up to this bound; squared distances of 512 components then fit in 64 bits.
LARGEST = 1 << 26
#: Vectors that a task compares at once.
ROWS = 8_192


@dataclass(frozen=True)
class Codebooks:
    """`entries[p][i]`: entry i of part p. `far[p][i]`: no part of the entry's ball is farther from it, as a squared distance."""

    entries: np.ndarray
    far: np.ndarray | None = None

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors, times the scale, that rows of codes stand for."""
        return np.concatenate([self.entries[p][codes[:, p]] for p in range(len(self.entries))], axis=1)


def _cut(column: pa.ListArray, parts: int) -> np.ndarray:
    """(parts, rows, components): scaled floors, with zeros behind vectors that don't divide evenly."""
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(values.reshape(n, len(values) // max(n, 1)) * SCALE).astype(np.int64)
    wide = -(-x.shape[1] // parts) * parts
    x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
    return np.ascontiguousarray(x.reshape(n, parts, wide // parts).transpose(1, 0, 2))


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each row by comparing with all, ties to the smaller index; exact."""
    if (int(max(abs(x).max(initial=0), abs(entries).max(initial=0))) * 2) ** 2 * max(x.shape[1], 1) < 1 << 53:
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((c * c).sum(1) - 2 * (a @ c.T)).argmin(1)
    best, own = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    for i, entry in enumerate(entries):
        d = ((x - entry) ** 2).sum(1)
        best, own = np.where(d < best, d, best), np.where(d < best, i, own)
    return own


def neighbours(entries: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(others, gaps): for each ball the entries within twice its radius, nearest first, and their squared gaps; -1 behind the last."""
    gaps = ((entries[:, None] - entries[None]) ** 2).sum(2)
    np.fill_diagonal(gaps, -1)
    others = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
    gaps = np.take_along_axis(gaps, others, 1)
    outside = gaps > 4 * far[:, None]
    keep = int((~outside).sum(1).max(initial=0))
    return np.where(outside, -1, others)[:, :keep], np.where(outside, -1, gaps)[:, :keep]


def reassign(x: np.ndarray, own: np.ndarray, entries: np.ndarray, others: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """The nearest entry of each row of balls `own`: stable cores stay, a row in ring t meets its t nearest neighbours."""
    best, out = ((x - entries[own]) ** 2).sum(1), own.copy()
    # An entry at gap g from the ball's can be as near as the ball's own only if g is at most twice the row's distance.
    ring = ((gaps[own] >= 0) & (gaps[own] <= 4 * best[:, None])).sum(1)
    for t in range(int(ring.max(initial=0))):
        rows = np.flatnonzero(ring > t)
        entry = others[own[rows], t]
        d = ((x[rows] - entries[entry]) ** 2).sum(1)
        nearer = (d < best[rows]) | ((d == best[rows]) & (entry < out[rows]))
        best[rows[nearer]], out[rows[nearer]] = d[nearer], entry[nearer]
    return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _codes(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """(parts, rows) of the column `code`."""
    return np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts).T.astype(np.int64)


def _assigned(rows: DataFrame, books: Codebooks, parts: int) -> DataFrame:
    """The rows with `code`, one byte for each part: from all entries where no radius is known, else from the balls they are in."""
    schema = rows.schema.simpleString()[7:-1] if "code" in rows.columns else rows.schema.simpleString()[7:-1] + ",code:binary"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [neighbours(e, f) for e, f in zip(books.entries, books.far)] if books.far is not None else None
        for batch in _batches(batches):
            x = _cut(batch.column("vector"), parts)
            if near is None:
                codes = [nearest(x[p], books.entries[p]) for p in range(parts)]
            else:
                own = _codes(batch, parts)
                codes = [reassign(x[p], own[p], books.entries[p], *near[p]) for p in range(parts)]
            packed = np.ascontiguousarray(np.array(codes, np.uint8).T)
            column = pa.array([r.tobytes() for r in packed], pa.binary())
            names = [n for n in batch.schema.names if n != "code"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], [*names, "code"])

    return rows.mapInArrow(assign, schema)


def _updated(rows: DataFrame, books: Codebooks, parts: int) -> Codebooks:
    """Entries moved to the floored means of their parts, with bounds of the radii around their new places."""
    width, count = books.entries.shape[2], books.entries.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, far = np.zeros((parts, count), np.int64), np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
        for batch in _batches(batches):
            x, codes = _cut(batch.column("vector"), parts), _codes(batch, parts)
            for p in range(parts):
                n[p] += np.bincount(codes[p], minlength=count)
                np.add.at(total[p], codes[p], x[p])
                np.maximum.at(far[p], codes[p], ((x[p] - books.entries[p][codes[p]]) ** 2).sum(1))
        p, i = np.nonzero(n)
        columns = [pa.array(p, pa.int32()), pa.array(i, pa.int32()), pa.array(n[p, i]), pa.array(far[p, i]), pa.array(list(total[p, i]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "far", "total"])

    partial = rows.select("vector", "code").mapInArrow(sums, "part int, entry int, n long, far long, total array<long>")
    whole = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.max("far").alias("far"), F.array(*(F.sum(F.col("total")[j].cast("decimal(38,0)")) for j in range(width))).alias("total")
    )
    entries, far = books.entries.copy(), np.zeros((parts, count), np.int64)
    for r in whole.collect():  # at most parts x entries rows
        entries[r.part, r.entry] = [int(t) // r.n for t in r.total]
        moved = math.sqrt(sum((int(a) - int(b)) ** 2 for a, b in zip(entries[r.part, r.entry], books.entries[r.part, r.entry])))
        # Rounded up: a bound that is too wide only keeps more neighbours.
        far[r.part, r.entry] = math.ceil((math.sqrt(r.far) + moved + 1e-6) ** 2 * (1 + 1e-9)) + 1
    return Codebooks(entries, far)


def fit(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks] | None:
    """(vec_id, label, vector, code) of every kept row, stored, and the codebooks after `rounds` rounds; None where no row is kept.

    Left out: null vectors and vectors with null or non-finite components, with components beyond LARGEST / SCALE, or of
    another length than the vector of the smallest id. Entries start as the parts of the rows of the smallest ids (null
    ids last, equal ids in the order of their vectors); fewer rows give fewer entries. Repeated ids keep all their rows.
    A missing label column counts as null labels. A length that `parts` doesn't divide is filled up with zeros.
    """
    given = F.col(label) if label in embeddings.columns else F.lit(None).cast("int")
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), given.alias("label"), F.col(vector).alias("vector"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) * SCALE >= LARGEST)
    rows = rows.where(F.col("vector").isNotNull() & ~F.exists("vector", bad))
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    head = rows.select("vec_id", "vector").orderBy(*by_id).limit(1).collect()
    if not head:
        return None
    rows = rows.where(F.size("vector") == len(head[0].vector))
    first = rows.select("vec_id", "vector").orderBy(*by_id).limit(entries).collect()
    books = Codebooks(_cut(pa.array([r.vector for r in first], pa.list_(pa.float64())), parts))
    for _ in range(rounds):
        rows = stored(_assigned(rows, books, parts), "codes")
        books = _updated(rows, books, parts)
    return stored(_assigned(rows, books, parts), "codes"), books


def compress(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): `fit`, with the codes in hexadecimal and their squared errors.

    `label_error` sums the errors of equal labels, null labels together. No kept row: no row.
    """
    kind = embeddings.schema[vec_id].dataType.simpleString()
    fitted = fit(embeddings, vec_id, vector, label, parts, entries, rounds)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    rows, books = fitted

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            x, codes = _cut(batch.column("vector"), parts), _codes(batch, parts)
            error = sum(((x[p] - books.entries[p][codes[p]]) ** 2).sum(1) for p in range(parts))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("code"), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    schema = f"vec_id {kind}, label {rows.schema['label'].dataType.simpleString()}, code binary, error long"
    told = stored(rows.mapInArrow(errors, schema), "errors")
    by_label = told.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = told.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
