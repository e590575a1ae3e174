"""Sliding features of sorted rows, in one pass over Arrow batches.

A pass holds the rows of one window of the key at hand and as many new ones; sums are exact, in four limbs of 32 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.config import HOUR_MS

#: New rows that are taken at once, at least; more where a window holds more, so that each row is taken twice on average.
CHUNK = 1 << 16
_MASK = (1 << 32) - 1
_MONEY = pa.decimal128(38, 8)
_TOO_LARGE = 10**38 >> 96


def _halves(amounts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Low and high 64 bits of decimals."""
    words = np.frombuffer(amounts.buffers()[1], np.int64, 2 * len(amounts), 16 * amounts.offset)
    return words[0::2], words[1::2]


def _decimals(low: np.ndarray, high: np.ndarray) -> pa.Array:
    words = np.empty(2 * len(low), np.int64)
    words[0::2], words[1::2] = low, high
    return pa.Array.from_buffers(_MONEY, len(low), [None, pa.py_buffer(words)])


def _running(values: np.ndarray) -> np.ndarray:
    """Sums of the first rows: one more than there are rows."""
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def _sums(limbs: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Sums over the rows from `begin` to before `end`, of running sums of limbs, lowest first."""
    carry, parts = 0, []
    for running in limbs:
        total = running[end] - running[begin] + carry
        carry = total >> 32
        parts.append(total & _MASK)
    if len(total) and np.abs(total).max() >= _TOO_LARGE:
        raise ArithmeticError("a sum of amounts passes 38 digits")
    return _decimals(parts[0] | parts[1] << 32, parts[2] | total << 32)


def _largest(rank: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The largest of the rows from `begin` to before `end`, none of them empty, from maxima of 1, 2, 4... rows."""
    level = np.frexp((end - begin).astype(np.float64))[1] - 1
    out, table = np.zeros(len(begin), rank.dtype), rank
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.maximum(table[:-half], table[half:])
        own = np.flatnonzero(level == k)
        out[own] = np.maximum(table[begin[own]], table[end[own] - (1 << k)])
    return out


def _present(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, pos: np.ndarray, span: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Weights of the distinct values within the span, each once. Negative values are none.

    A use that finds the value gone, or new, begins a spell, and a use that isn't followed within the span ends it when it
    leaves the window.
    """
    used = np.flatnonzero(value >= 0)
    order = used[np.lexsort((used, value[used], owner[used]))]
    same = (owner[order[1:]] == owner[order[:-1]]) & (value[order[1:]] == value[order[:-1]]) & (pos[order[1:]] - pos[order[:-1]] < span)
    begins, ends = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    begins[order] = np.where(np.concatenate([[False], same])[: len(order)], 0, weight[order])
    ends[order] = np.where(np.concatenate([same, [False]])[-len(order) :] if len(order) else same, 0, weight[order])
    return _running(begins)[end] - _running(ends)[begin]


class _Rows:
    """Sorted rows, told apart by owner; times are drawn together where nothing slides over them."""

    def __init__(self, table: pa.Table, keys: list[str], longest: int):
        self.table = table.unify_dictionaries().combine_chunks()
        column = lambda name: self.table.column(name).chunk(0)
        code = lambda name: column(name).indices.fill_null(-1).to_numpy().astype(np.int64)
        self.at, self.own = column("at").to_numpy(), column("own").to_numpy(zero_copy_only=False)
        self.column, self.code = column, code
        differs = column("part").to_numpy()[1:] != column("part").to_numpy()[:-1]
        for key in keys:
            own = code(key)
            differs |= own[1:] != own[:-1]
        self.owner = np.concatenate([[0], np.cumsum(differs)])
        ticks = self.at.view(np.uint64)
        gaps = np.minimum(ticks[1:] - ticks[:-1], np.uint64(longest + 1)).astype(np.int64)
        self.pos = np.concatenate([[0], np.cumsum(np.where(differs, longest + 1, gaps))])


def _features(rows: _Rows, moments: np.ndarray, keys: list[str], spans: dict[str, int]) -> pa.RecordBatch:
    """Counts and sums over each span, distinct values and the largest amount over the longest, at the rows that end a moment."""
    low, high = _halves(rows.column("usd"))
    limbs = [_running(part) for part in (low & _MASK, low >> 32 & _MASK, high & _MASK, high >> 32)]
    end, longest = moments + 1, max(spans.values())
    out = {key: rows.column(key).take(pa.array(moments)).dictionary_decode() for key in keys} | {"at": pa.array(rows.at[moments])}
    for name, span in spans.items():
        begin = np.searchsorted(rows.pos, rows.pos[moments] - span, "right")
        out |= {f"n_{name}": pa.array(end - begin), f"usd_{name}": _sums(limbs, begin, end)}
    begin = np.searchsorted(rows.pos, rows.pos[moments] - longest, "right")
    hour, one = rows.at // HOUR_MS % 24, np.ones(len(rows.at), np.int64)
    for name, value, weight in (("tokens", rows.code("token"), one), ("protocols", rows.code("protocol"), one), ("hours", hour, one << hour)):
        out[name] = pa.array(_present(rows.owner, value, weight, rows.pos, longest, begin, end))
    order = np.lexsort((low.view(np.uint64), high))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    most = order[_largest(rank, begin, end)]
    out["largest"] = _decimals(low[most], high[most])
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def slide(batches: Iterator[pa.RecordBatch], keys: list[str], spans: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Features at every moment of rows (keys, part, at, usd, token, protocol, own), sorted by keys, part and `at`.

    Rows of one moment of a part lie together. Moments of rows that aren't `own` only lead in and give no result.
    """
    texts = [*keys, "token", "protocol"]
    held, told, fresh = [], 0, 0
    longest = max(spans.values())

    def encoded(table: pa.Table) -> pa.Table:
        """Texts as numbers of those that occur, and no others."""
        for text in texts:
            column = table.column(text)
            plain = column.cast(column.type.value_type) if pa.types.is_dictionary(column.type) else column
            table = table.set_column(table.schema.get_field_index(text), text, plain.dictionary_encode())
        return table

    def taken(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, told, fresh
        rows = _Rows(pa.concat_tables(held), keys, longest)
        closed = np.flatnonzero(np.diff(rows.pos))
        if last:
            closed = np.append(closed, len(rows.pos) - 1)
        due = closed[closed >= told]
        shown = due[rows.own[due]]
        if len(shown):
            yield _features(rows, shown, keys, spans)
        done = int(due[-1]) + 1 if len(due) else told
        first = int(np.searchsorted(rows.pos, rows.pos[done] - longest, "right")) if done < len(rows.pos) else done
        held, told, fresh = [encoded(rows.table.slice(first).combine_chunks())], done - first, 0

    for batch in batches:
        if batch.num_rows:
            held.append(encoded(pa.Table.from_batches([batch])))
            fresh += batch.num_rows
            if fresh >= max(CHUNK, told):
                yield from taken(False)
    if held and sum(t.num_rows for t in held):
        yield from taken(True)
