"""Best-fit packing of token sequences: local best fit, nearly full bins leave, the rest go up a tree as items.

Every task packs a block of pieces by best fit in falling order. A bin with little room left is final. Every other bin
becomes one item of the next round, in which fewer tasks pack the bins of several tasks; rounds end at one task, or where
no two bins fit together. Only lengths travel: token ids stay where they are made, unless `sequences` is asked for them.
"""

from __future__ import annotations

import array
import bisect
import sys
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel

from tidemark.llm.common import stored

CAPACITY = 2048
#: Room that makes a bin nearly full, pieces or bins that a task packs together, and tasks of a round that become one.
SLACK, BLOCK, FAN_IN = 8, 8_192, 8
#: Tasks of the first round at most; beyond it tasks pack several blocks of LARGE_BLOCK pieces.
MOST_TASKS, LARGE_BLOCK = 4_096, 1 << 20
#: Words and other texts between blanks whose ids a task remembers.
REMEMBERED = 1 << 20
#: Fixed value: the pattern by which a byte-level tokenizer cuts a text before it merges bytes.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Marks that end many words and are words of that pattern by themselves.
_MARKS = ".,;:!?)"


class _Remembered(dict):
    """Token ids, as little-endian bytes, of what stands behind a blank, found at first use; emptied when full.

    A word with a mark behind it isn't kept: it is put together from the two.
    """

    def __init__(self, encode: Callable[[str], bytes], marks: dict[str, bytes]):
        self.encode, self.marks = encode, marks

    def __missing__(self, text: str) -> bytes:
        if text[-1:] in self.marks and text[:-1].isalpha():
            return self[text[:-1]] + self.marks[text[-1]]
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[text] = self.encode(text)
        return out


def _bytes(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes()


def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its token ids, as little-endian unsigned 32-bit numbers, without special tokens added.

    A byte-level tokenizer never joins bytes across the place where a blank follows a character that is none, so texts
    are cut there and repeated parts are looked up. Other tokenizers get whole texts.
    """
    tokenizer = Tokenizer.from_file(path)
    whole = lambda text: _bytes(tokenizer.encode(text, add_special_tokens=False).ids)
    before, special = tokenizer.pre_tokenizer, list(tokenizer.get_added_tokens_decoder().values())
    added = [a.content for a in special]
    cuttable = (
        isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space
        and tokenizer.normalizer is None and isinstance(tokenizer.model, BPE)
        and not any(" " in a.content or a.lstrip or a.rstrip for a in special)
    )
    if not cuttable:
        return whole
    model, pieces = tokenizer.model, regex.compile(BYTE_LEVEL)
    # Byte-level vocabularies write printable bytes as themselves and the others, in order, from character 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spelled = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    blank = chr(spelled[32])

    def word(text: str) -> bytes:
        # Most words are a blank and plain letters, of which only the blank is written otherwise.
        shown = text.replace(" ", blank) if text.isascii() and text.isprintable() else text.encode().decode("latin-1").translate(spelled)
        return _bytes([t.id for t in model.tokenize(shown)])

    def part(text: str) -> bytes:
        # Letters alone, behind one blank or none, are one word of the pattern.
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return word(text)
        if any(a in text for a in added):
            return whole(text)
        return b"".join([word(w) for w in pieces.findall(text)])

    # A mark behind letters is a word by itself, and so is what comes before it.
    known = _Remembered(lambda p: part(" " + p), {m: word(m) for m in _MARKS})
    inside, cut = regex.compile(r"\s "), regex.compile(r"(?<=\S)(?= )")

    def encode(text: str) -> bytes:
        if inside.search(text):
            return b"".join([known[p[1:]] if p[0] == " " else part(p) for p in cut.split(text) if p])
        head, *rest = text.split(" ")
        return (part(head) if head else b"") + b"".join([known[p] for p in rest])

    return encode


def shared_encoder(path: str) -> Callable[[str], bytes]:
    """The encoder of this worker process: tasks that follow each other in it share what it remembers.

    Task functions travel by value and bring modules of their own, so it is kept under a name of the process.
    """
    kept = vars(sys.modules.setdefault("_packing_encoders", ModuleType("_packing_encoders")))
    if path not in kept:
        kept[path] = encoder(path)
    return kept[path]


def _number(level: int) -> int:
    """The first of the numbers that this task may give to what it makes at a level."""
    return (level << 57) | (TaskContext.get().partitionId() << 37)


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, doc_id, piece, start, length, ids_crc32[, ids]): every text with the id `end` behind it, cut where it passes the capacity.

    Only the first piece of a longer text is shorter than the capacity. A null text is empty: one piece, one id. Null and
    repeated doc_ids keep a row for each row; `item` tells them apart. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    extra = ", ids array<int>" if keep_ids else ""
    last = _bytes([end])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, item = shared_encoder(path), _number(0)
        for batch in batches:
            row, item_, piece, start, length, crc, kept = [], [], [], [], [], [], []
            for i in range(batch.num_rows):
                ids = encode(batch.column(1)[i].as_py() or "") + last
                total = len(ids) // 4
                first = total if total <= capacity else total % capacity or capacity
                edges = [0, *range(first, total + 1, capacity)]
                for p, (a, b) in enumerate(zip(edges, edges[1:])):
                    view = ids[4 * a : 4 * b]
                    row.append(i)
                    item_.append(item)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(view))
                    item += 1
                    if keep_ids:
                        kept.append(np.frombuffer(view, "<i4"))
            columns = [pa.array(item_, pa.int64()), batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["item", "doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, f"item long, doc_id {kind}, piece int, start long, length long, ids_crc32 long{extra}")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: largest item first, into the bin with the least room that takes it."""
    rooms: dict[int, list[int]] = {}
    open_rooms: list[int] = []
    bins, offsets, fills = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(open_rooms, size)
        if at < len(open_rooms):
            room = open_rooms[at]
            own = rooms[room].pop()
            if not rooms[room]:
                del open_rooms[at], rooms[room]
        else:
            room, own = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = own, fills[own]
        fills[own] += size
        room -= size
        if room:
            if room not in rooms:
                bisect.insort(open_rooms, room)
                rooms[room] = []
            rooms[room].append(own)
    return bins, offsets, np.array(fills, np.int64)


def _packed(items: DataFrame, size: str, level: int, capacity: int) -> DataFrame:
    """The rows of `items`, each with its bin, its offset there and the fill of the bin."""
    schema = StructType([*items.schema, *(StructField(c, LongType()) for c in ("bin", "at", "fill"))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, number = [], 0, _number(level)

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, number
            block = pa.Table.from_batches(held).combine_chunks()
            bins, offsets, fills = best_fit(block.column(size).to_numpy(), capacity)
            for name, values in (("bin", bins + number), ("at", offsets), ("fill", fills[bins])):
                block = block.append_column(name, pa.array(values, pa.int64()))
            number += len(fills)
            held, rows = [], 0
            yield from block.to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= LARGE_BLOCK:
                yield from packed()
        if rows:
            yield from packed()

    return items.mapInArrow(pack, schema)


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with `sequence_id` and `offset`; a piece as long as the capacity is a sequence of its own.

    `pieces` has unique longs `item` and a long `length` from 1 to the capacity, and is read twice: store it first. No
    piece is lost or cut, sequences have no gaps, and no two of the last round's bins that share a task could have been one.
    """
    small = pieces.where(F.col("length") < capacity)
    groups = min(MOST_TASKS, max(1, -(-small.count() // BLOCK)))
    first = stored(_packed(small.repartition(groups, F.xxhash64("item")), "length", 1, capacity), "packed")
    rounds, current = [], first
    while groups > 1:
        left = current.where((F.col("at") == 0) & (F.col("fill") < capacity - SLACK)).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        bins, least = left.agg(F.count("*"), F.min("size")).first()
        before, groups = groups, max(-(-groups // FAN_IN), -(-bins // LARGE_BLOCK))
        if bins < 2 or 2 * least > capacity or groups >= before:
            break
        # A bin that the least full one does not fit into stays as it is.
        left = left.where(F.col("size") + least <= capacity).repartition(groups, F.xxhash64("item", F.lit(len(rounds))))
        current = stored(_packed(left, "size", len(rounds) + 2, capacity), "packed")
        rounds.append(current)
    moved = None
    for step in reversed(rounds):
        step = step.select(F.col("item").alias("inner"), F.col("bin").alias("outer"), F.col("at").alias("shift"))
        if moved is not None:
            later = moved.select(F.col("inner").alias("outer"), F.col("outer").alias("last"), F.col("shift").alias("more"))
            step = step.join(later, "outer", "left").select("inner", F.coalesce("last", "outer").alias("outer"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        moved = step
    names = [c for c in pieces.columns if c != "item"]
    if moved is None:
        out = first.withColumns({"outer": F.col("bin"), "shift": F.lit(0)})
    else:
        out = first.join(moved.withColumnRenamed("inner", "bin"), "bin", "left")
    out = out.select(*names, F.coalesce("outer", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"))
    full = pieces.where(F.col("length") == capacity)
    return out.unionByName(full.select(*names, F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Where each piece of each document lies: doc_id, piece, start, length, ids_crc32, sequence_id, offset. No document: no row."""
    return packed(stored(tokenized(docs, path, capacity, end), "pieces"), capacity)


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """(sequence_id, doc_ids, ids): the packed sequences themselves, at most `capacity` ids each."""
    placed = packed(stored(tokenized(docs, path, capacity, end, keep_ids=True), "pieces"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.flatten("parts.ids").alias("ids"))
