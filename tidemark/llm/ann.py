"""Nearest neighbours: a hierarchical k-means tree, searched best bin first with as many leaf visits as recall asks for."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

K = 10
BRANCHES = 8
LEAF_ROWS = 256
#: Bounds of the samples that the driver holds: vectors that the tree is fitted on, and queries that visits are calibrated on.
FIT_ROWS = 16_384
CALIBRATION_QUERIES = 128
TARGET_RECALL = 0.97
#: Rows and queries that meet in one task at most.
ROW_BLOCK, QUERY_BLOCK = 8_192, 2_048


@dataclass(frozen=True)
class Tree:
    """Node i has children `children[i]` (none: a leaf, numbered by `leaf[i]`) and the centre `centres[i]`."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    leaf: tuple[int, ...]
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row falls to by the nearest centre of every level, ties to the first."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids or not len(rows):
                out[rows] = self.leaf[node]
                continue
            best = nearest(x[rows], self.centres[list(kids)])
            todo += [(kid, rows[best == i]) for i, kid in enumerate(kids)]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in the order in which a priority queue by distance to the centres yields them."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(self.leaf[node])
                continue
            far = ((self.centres[list(kids)] - q) ** 2).sum(1)
            for d, kid in zip(far.tolist(), kids, strict=True):
                heapq.heappush(queue, (d, kid))
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2.0 * (x @ centres.T)).argmin(1)


def fit_tree(sample: np.ndarray, rows: int, seed: int = 7) -> Tree:
    """k-means, level by level, until a node stands for LEAF_ROWS of `rows` rows or for 16 of the sample."""
    rng = np.random.default_rng(seed)
    centres, children, leaf, leaves = [sample.mean(0) if len(sample) else np.zeros(0)], [()], [0], 0
    smallest = max(16, LEAF_ROWS * len(sample) / max(rows, 1))
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, own = todo.pop()
        parts = _split(sample[own], rng) if len(own) > smallest else []
        if len(parts) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        first = len(centres)
        children[node] = tuple(range(first, first + len(parts)))
        for centre, members in parts:
            todo.append((len(centres), own[members]))
            centres.append(centre)
            children.append(())
            leaf.append(-1)
    return Tree(np.array(centres, np.float64), tuple(children), tuple(leaf), leaves)


def _split(x: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    distinct = np.unique(x, axis=0)
    if len(distinct) < 2:
        return []
    centres = distinct[rng.permutation(len(distinct))[: min(BRANCHES, len(distinct))]].astype(np.float64)
    for _ in range(12):
        best = nearest(x, centres)
        centres = np.array([x[best == i].mean(0) if (best == i).any() else c for i, c in enumerate(centres)])
    best = nearest(x, centres)
    return [(centres[i], np.flatnonzero(best == i)) for i in range(len(centres)) if (best == i).any()]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def _closest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and Euclidean distances of the k nearest rows, ties to the smaller id; rows of the query's id are left out."""
    d = x - q
    far = np.sqrt(np.einsum("ij,ij->i", d, d))
    far[ids == own] = np.inf
    near = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1]) if len(far) > k else np.arange(len(far))
    near = near[np.isfinite(far[near])]
    near = near[np.lexsort((ids[near], far[near]))][:k]
    return near, far[near]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v as array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & sound).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _sample(vectors: DataFrame, rows: int, salt: int) -> pd.DataFrame:
    return vectors.orderBy(F.xxhash64("vec_id", F.lit(salt)), "vec_id", "v").limit(rows).toPandas()


def search(vectors: DataFrame, query_modulus: int = 100, k: int = K, target: float = TARGET_RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of every row whose id is divisible by `query_modulus`.

    The tree is fitted on FIT_ROWS rows at most; every row is indexed. Visits are the fewest leaves that hold `target`
    of the true neighbours of CALIBRATION_QUERIES queries, found by comparing those with all rows. Null, zero and
    non-finite vectors, rows without an id, and vectors whose length isn't the commonest of the sample take no part. A
    repeated id is one query; its rows are all candidates of other queries. Ties go to the smaller id. A table without
    queries or rows gives no rows. Other columns are ignored.
    """
    good = usable(vectors)
    sample = _sample(good, FIT_ROWS, 1)
    size = int(sample.v.map(len).mode().min()) if len(sample) else 0
    good = good.where(F.size("v") == size)
    fit = _matrix(sample.v[sample.v.map(len) == size]) if len(sample) else np.zeros((0, 0))
    tree = fit_tree(fit, good.count())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, max(size, 1))
            yield b.append_column("leaf", pa.array(tree.assign(x)))

    indexed = stored(good.mapInArrow(place, "vec_id long, v array<double>, leaf long"), "ann-index")
    # One row for each leaf, and there are FIT_ROWS / 16 leaves at most.
    held = {r.leaf: r.n for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    cells = packed(held, tree.leaves)
    queries = indexed.where(F.col("vec_id") % query_modulus == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    most = _visits_needed(tree, indexed, queries, k, target)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for query, q in zip(f.query_id, f.q, strict=True):
                by_cell: dict[int, list[int]] = {}
                for leaf in tree.visits(np.asarray(q), most):
                    by_cell.setdefault(cells[leaf], []).append(leaf)
                out += [(query, q, cell, leaves) for cell, leaves in by_cell.items()]
            yield pd.DataFrame(out, columns=["query_id", "q", "cell", "leaves"])

    routed = stored(queries.mapInPandas(route, "query_id long, q array<double>, cell long, leaves array<long>"), "ann-visits")
    asked = {r.cell: r.n for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    rows_of: dict[int, int] = {}
    for leaf, n in held.items():
        rows_of[cells[leaf]] = rows_of.get(cells[leaf], 0) + n
    row_parts = {cell: math.ceil(n / ROW_BLOCK) for cell, n in rows_of.items()}
    query_parts = {cell: math.ceil(n / QUERY_BLOCK) for cell, n in asked.items()}
    count = max(cells, default=0) + 1
    placed = indexed.withColumn("cell", F.element_at(F.lit(cells or [0]), (F.col("leaf") + 1).cast("int")).cast("long"))
    rows = _dealt(placed, "vec_id", "row_part", row_parts, "query_part", query_parts, count)
    probes = _dealt(routed, "query_id", "query_part", query_parts, "row_part", row_parts, count)
    key = ["cell", "row_part", "query_part"]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values("leaf", kind="stable")
            x, ids, leaf = _matrix(left.v), left.vec_id.to_numpy(), left.leaf.to_numpy()
            for query, q, visited in zip(right.query_id, right.q, right.leaves, strict=True):
                own = np.concatenate([np.arange(*np.searchsorted(leaf, (i, i + 1))) for i in visited])
                near, far = _closest(np.asarray(q, np.float64), x[own], ids[own], query, k)
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[own[near]], "score": far}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    found = rows.groupBy(*key).cogroup(probes.groupBy(*key)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def packed(held: dict[int, int], leaves: int) -> list[int]:
    """The cell of each leaf: neighbouring leaves share one while they have ROW_BLOCK rows together at most."""
    out, cell, rows = [], 0, 0
    for leaf in range(leaves):
        n = held.get(leaf, 0)
        if rows and rows + n > ROW_BLOCK:
            cell, rows = cell + 1, 0
        out.append(cell)
        rows += n
    return out


def _dealt(df: DataFrame, by: str, own: str, own_parts: dict[int, int], other: str, other_parts: dict[int, int], cells: int) -> DataFrame:
    """Deal the rows of a cell to its parts, and copy each to every part of the other side."""
    table = lambda parts: F.element_at(F.lit([parts.get(i, 1) for i in range(cells)]), (F.col("cell") + 1).cast("int"))
    dealt = df.withColumn(own, F.pmod(F.xxhash64(by), table(own_parts)).cast("int"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), table(other_parts) - 1)))


def _visits_needed(tree: Tree, indexed: DataFrame, queries: DataFrame, k: int, target: float) -> int:
    """The fewest visits whose leaves hold `target` of the true neighbours of a bounded set of queries."""
    probe = queries.orderBy(F.xxhash64("query_id", F.lit(2)), "query_id").limit(CALIBRATION_QUERIES).toPandas()
    pairs = list(zip(probe.query_id.tolist(), [np.asarray(q, np.float64) for q in probe.q], strict=True))

    def truth(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x, ids, leaf = _matrix(f.v), f.vec_id.to_numpy(), f.leaf.to_numpy()
            for query, q in pairs if len(f) else ():
                near, far = _closest(q, x, ids, query, k)
                yield pd.DataFrame({"query_id": query, "vec_id": ids[near], "score": far, "leaf": leaf[near]})



    order = Window.partitionBy("query_id").orderBy("score", "vec_id", "leaf")
    best = indexed.mapInPandas(truth, "query_id long, vec_id long, score double, leaf long")
    rows = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect() if pairs else []
    turns = {query: {leaf: i + 1 for i, leaf in enumerate(tree.visits(q, tree.leaves))} for query, q in pairs}
    needed = sorted(turns[r.query_id][r.leaf] for r in rows)
    return needed[max(0, math.ceil(target * len(needed)) - 1)] if needed else 1
