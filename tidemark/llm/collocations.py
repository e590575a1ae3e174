"""Collocations: phrases of two and three words that occur more often than their parts let expect.

Texts are read twice. The first pass counts 64-bit hashes of words and pairs; a bit for each frequent hash, in a table of
bounded size, then tells the second pass which words, pairs and runs of two such pairs can be frequent at all, and only
these are counted, as strings and exactly. The bits leave out nothing frequent, and what they let by in error goes by its
exact count; a table too small for a corpus makes the second pass count more, not otherwise.

What occurs often enough is kept as two streams over the same counts. In suffix order (last word first) a phrase follows
its last word and its last two words; in prefix order it follows its first word and its first two. One pass over each
sorted stream therefore hands every phrase the counts of its parts, and every pair its most frequent extension, with two
numbers carried along: nothing is looked up. Streams are cut by range, so a frequent word may span any number of tasks;
the few rows at the head of a task, whose parts went to the task before, are completed afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import TILE, lower_ascii, mixed, stored, utf8, word_hashes

LEAST, TOP, SHARE, SCALE = 10, 2_000, 50, 1_000_000
#: Bytes of texts that a task counts together, before counts go to the shuffle.
BLOCK = 2 * TILE
#: Rows that a task hands over at once.
ROWS = 1 << 16
#: Bits for each frequent hash, and the bounds of the table of bits (32 MiB at most).
BITS_EACH, FEWEST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28
#: Bits of one row of the table, which is what Spark's bitmap aggregate builds.
_ROW_BITS = 1 << 15

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


@dataclass
class _Words:
    """Word i has the number `number[i]` (from 1) in `names`, stands in value `value[i]` and is followed in its piece if `linked[i]`.

    Phrases begin at the first `keep` words; the others only follow. `following`: the byte at which the next part of the text begins.
    """

    names: pa.Array
    number: np.ndarray
    linked: np.ndarray
    value: np.ndarray
    keep: int
    following: int


def _words(data: np.ndarray, offsets: np.ndarray, cut: bool) -> _Words | None:
    """The words of values; None where a `cut` text, which goes on behind its last byte, has too few to go on from."""
    solid, edge = ~_GAP[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, finish = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    finish[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    following = -1
    if cut:  # the last word may go on, and the two before it lack their followers
        if len(starts) < 4:
            return None
        starts, ends, following = starts[:-1], ends[:-1], int(starts[-3])
    value = np.searchsorted(offsets, starts, "right") - 1
    data = lower_ascii(data[: ends[-1] if len(ends) else 0])
    ends_in = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=ends_in[1:])
    names = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_in), pa.py_buffer(data[solid[: len(data)]])).dictionary_encode()
    number = names.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    breaks = np.cumsum(_BREAK[data], dtype=np.int32)[starts] if len(starts) else starts
    linked = np.zeros(len(starts), bool)
    linked[:-1] = (value[1:] == value[:-1]) & (breaks[1:] == breaks[:-1])
    return _Words(names.dictionary, number, linked, value, len(starts) - 2 if cut else len(starts), following)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, _Words]]:
    """(languages, language of each word, words) of blocks of (lang, text); a text longer than a block comes in overlapping parts."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        data, offsets = utf8(batch.column(1))
        first, n = 0, len(offsets) - 1
        while first < n:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
            block, own = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            at, size, single = 0, BLOCK, last == first + 1
            while at < len(block):
                going_on = single and at + size < len(block)
                part = block[at : at + size] if single else block
                words = _words(part, np.array([0, len(part)]) if single else own, going_on)
                if words is None:
                    size *= 2
                    continue
                yield langs.dictionary, lang[first + words.value], words
                at, size = at + words.following if going_on else len(block), BLOCK
            first = last


def _hashed(langs: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of languages, and of words by number (0 stands for none)."""
    by_lang = [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little") for name in langs.to_pylist()]
    data, offsets = utf8(words)
    return np.array(by_lang, np.uint64), np.concatenate([np.zeros(1, np.uint64), word_hashes(data, offsets[:-1], offsets[1:])])


def _handed(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, ROWS):
        yield rows.slice(at, ROWS)
    pa.default_memory_pool().release_unused()


def _hash_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n) of the words and pairs of blocks."""
    for langs, lang, words in _parts(batches):
        base, keep = len(words.names) + 1, words.keep
        by_lang, by_word = _hashed(langs, words.names)
        one, n1 = np.unique((lang * base + words.number)[:keep], return_counts=True)
        pair = np.flatnonzero(words.linked[:keep])
        two, n2 = np.unique((lang[pair] * base + words.number[pair]) * base + words.number[pair + 1], return_counts=True)
        h = np.concatenate([_one(by_lang, by_word, one, base), _two(by_lang, by_word, two, base)]).view(np.int64)
        yield from _handed(pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.concatenate([n1, n2]), pa.int64())], ["h", "n"]))


def _one(by_lang: np.ndarray, by_word: np.ndarray, keys: np.ndarray, base: int) -> np.ndarray:
    return mixed(by_lang[keys // base] ^ by_word[keys % base])


def _two(by_lang: np.ndarray, by_word: np.ndarray, keys: np.ndarray, base: int) -> np.ndarray:
    return mixed(_one(by_lang, by_word, keys // base, base) * np.uint64(0x9E3779B97F4A7C15) + by_word[keys % base])


def _counted(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, n) of the words, pairs and runs of two pairs that the bits let by, and of no word: all words of a language.

    A key is one string, words between blanks and the language behind a tab, which no word holds.
    """
    mask = np.uint64(len(bits) * 8 - 1)

    def frequent(h: np.ndarray) -> np.ndarray:
        at = h & mask
        return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    for langs, lang, words in _parts(batches):
        base, keep, number = len(words.names) + 1, words.keep, words.number
        by_lang, by_word = _hashed(langs, words.names)
        one, n1 = np.unique((lang * base + number)[:keep], return_counts=True)
        let = frequent(_one(by_lang, by_word, one, base))
        all_words = np.bincount(lang[:keep], minlength=len(langs))
        pair = np.flatnonzero(words.linked)
        two, of = np.unique((lang[pair] * base + number[pair]) * base + number[pair + 1], return_inverse=True)
        good = frequent(_two(by_lang, by_word, two, base))
        n2 = np.bincount(of[pair < keep], minlength=len(two))
        at_word = np.full(len(number) + 1, -1, np.int64)
        at_word[pair[good[of]]] = of[good[of]]
        run = np.flatnonzero((at_word[:keep] >= 0) & (at_word[1 : keep + 1] >= 0))
        three, n3 = np.unique(at_word[run] * base + number[run + 2], return_counts=True)
        two_of_three = two[three // base]
        good &= n2 > 0
        keys = [(np.arange(len(langs)), all_words), (one[let] // base, one[let] % base, n1[let])]
        keys += [(two[good] // base // base, two[good] // base % base, two[good] % base, n2[good])]
        keys += [(two_of_three // base // base, two_of_three // base % base, two_of_three % base, three % base, n3)]
        texts = pa.concat_arrays([pa.array([""], words.names.type), words.names])
        for own, *of_words, n in keys:
            parts = [pc.cast(texts.take(pa.array(w)), pa.string()) for w in of_words]
            phrase = pc.binary_join_element_wise(*parts, " ") if parts else pa.array([""] * len(n), pa.string())
            key = pc.binary_join_element_wise(phrase, pc.cast(langs.take(pa.array(own)), pa.string()), "\t")
            yield from _handed(pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64())], ["key", "n"]))


def _bits(pieces: DataFrame, least: int) -> np.ndarray:
    """A bit for each hash of a word or pair that occurs `least` times, as bytes; at most MOST_BITS."""
    hashes = pieces.mapInArrow(_hash_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    hashes = stored(hashes.select("h"), "hashes")
    size = 1 << (hashes.count() * BITS_EACH).bit_length()
    size = min(max(size, FEWEST_BITS), MOST_BITS)
    place = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = hashes.groupBy(F.shiftright(place, 15).cast("int").alias("row")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bits"))
    out = np.zeros((size // _ROW_BITS, _ROW_BITS // 8), np.uint8)
    for r in rows.toLocalIterator():
        out[r.row] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def counts(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, w1, w2, w3, f) of all phrases of up to three words that occur `least` times, w2 and w3 empty for shorter ones; (lang, n) words in all)."""
    pieces = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text is not null")
    bits = docs.sparkSession.sparkContext.broadcast(_bits(pieces, least))
    blocks = pieces.mapInArrow(lambda batches: _counted(batches, bits.value), "key string, n long")
    whole = blocks.groupBy("key").agg(F.sum("n").alias("f")).where(F.col("key").startswith("\t") | (F.col("f") >= least))
    words = F.split(F.substring_index("key", "\t", 1), " ")
    columns = [F.coalesce(F.get(words, F.lit(i)), F.lit("")).alias(f"w{i + 1}") for i in range(3)]
    kept = stored(whole.select(F.expr("substring(key, locate('\t', key) + 1)").alias("lang"), *columns, "f"), "phrases")
    return kept.where("w1 <> ''"), kept.where("w1 = ''").select("lang", F.col("f").alias("n"))


def _carried(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    """A sorted stream with, for each row, the counts of its first key and of its first two, and for each pair its most frequent extension.

    Null: the row with that count has not come by in this task. The last pair waits until its extensions have passed.
    """
    one, two, waiting, most = -1, -1, None, 0
    given = lambda v: pa.array(v, pa.int64(), mask=v < 0)

    def shown(rows: pa.RecordBatch, c1: np.ndarray, c2: np.ndarray, ext: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, given(c1), given(c2), given(ext)], [*rows.schema.names, *names])

    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        full = [pc.not_equal(batch.column(k), "").to_numpy(zero_copy_only=False).astype(bool) for k in keys[1:]]
        size = 1 + full[0].astype(int) + full[1]
        f = batch.column("f").to_numpy()
        at = np.arange(rows)
        last = lambda k, before: np.where((p := np.maximum.accumulate(np.where(size == k, at, -1))) >= 0, f[p], before)
        c1, c2 = np.where(size > 1, last(1, one), -1), np.where(size > 2, last(2, two), -1)
        one, two = int(last(1, one)[-1]), int(last(2, two)[-1])
        # Extensions follow their pair: each run of them belongs to the row before it.
        ext, longer = np.full(rows, -1), np.where(size == 3, f, 0)
        heads = np.flatnonzero(size < 3)
        before = longer[: heads[0]] if len(heads) else longer
        if waiting is not None:
            most = max(most, int(before.max(initial=0)))
            if len(heads):
                yield shown(*waiting, np.array([most]))
                waiting = None
        if len(heads):
            ext[heads] = np.maximum.reduceat(longer, heads)
            ext[size != 2] = -1
        keep = np.ones(rows, bool)
        if len(heads) and size[heads[-1]] == 2:
            p = int(heads[-1])
            waiting, most, keep[p] = (batch.slice(p, 1), c1[p : p + 1], c2[p : p + 1]), int(ext[p]), False
        yield shown(batch.filter(pa.array(keep)), c1[keep], c2[keep], ext[keep])
    if waiting is not None:
        yield shown(*waiting, np.array([most]))


def merged(phrases: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """`phrases` with the counts of their first one and two `keys` and the largest count that extends them, from one sorted pass."""
    one, two, ext = names
    schema = phrases.schema.simpleString()[7:-1] + "".join(f",{n}:bigint" for n in names)
    order = ["lang", *keys]
    stream = phrases.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(stream.mapInArrow(lambda b: _carried(b, keys, names), schema), "merged")
    # A task has at most one first word and one first pair that began in a task before it, so these tables have no more rows than there are tasks.
    pair, triple = F.col(keys[1]) != "", F.col(keys[2]) != ""
    open_word = rows.where(pair & F.col(one).isNull()).select("lang", keys[0]).distinct()
    open_pair = rows.where(triple & F.col(two).isNull()).groupBy("lang", *keys[:2]).agg(F.max("f").alias("seen"))
    word = phrases.where(~pair).join(F.broadcast(open_word), ["lang", keys[0]]).select("lang", keys[0], F.col("f").alias("f1"))
    both = phrases.where(pair & ~triple).join(F.broadcast(open_pair), ["lang", *keys[:2]]).select("lang", *keys[:2], F.col("f").alias("f2"), "seen")
    out = rows.join(F.broadcast(word), ["lang", keys[0]], "left").join(F.broadcast(both), ["lang", *keys[:2]], "left")
    return out.select(
        *phrases.columns,
        F.when(pair, F.coalesce(one, "f1")).alias(one),
        F.when(triple, F.coalesce(two, "f2")).alias(two),
        F.when(pair & ~triple, F.greatest(F.col(ext), F.coalesce("seen", F.lit(0)))).alias(ext),
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a a / (l r)) in decimals: exact up to counts of 10^16."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * whole(a) * whole(a), whole(left) * whole(right))


def mine(docs: DataFrame, least: int = LEAST, top: int | None = TOP, share: int = SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the first `top` of each language; None keeps all.

    Texts are lower-cased in A-Z and cut to pieces at `.,;:!?` and line ends, pieces to words at blanks and tabs. a, l and
    r count a phrase and its two parts at the cut with the lowest score, n all words of the language (null: `und`). A
    pair within a longer phrase that has at least `share` per cent of its count is left out. Null and empty texts have no
    words, repeated rows count each time, other columns are not read; without words there are no rows.
    """
    phrases, total = counts(docs, least, text, lang)
    both = merged(_backward(phrases), ["w1", "w2", "w3"], ["l1", "l2", "right"])
    rows = both.where("w2 <> ''").withColumn("s1", _score(F.col("f"), F.col("l1"), F.when(F.col("w3") == "", F.col("r1")).otherwise(F.col("r2"))))
    rows = rows.withColumn("s2", F.when(F.col("w3") != "", _score(F.col("f"), F.col("l2"), F.col("r1"))))
    late = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    inside = (F.col("w3") == "") & (100 * F.greatest("left", "right") >= share * F.col("f"))
    rows = rows.where(~inside).select(
        "lang",
        F.concat_ws(" ", "w1", "w2", F.nullif("w3", F.lit(""))).alias("phrase"),
        F.col("f").alias("a"),
        F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(late | (F.col("w3") == ""), F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.when(late, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = rows.withColumn("rank", place.cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _backward(phrases: DataFrame) -> DataFrame:
    """`phrases` with r1 and r2, counts of the last word and the last two, and `left`, the largest count of a word more in front."""
    w1, w2, w3 = F.col("w1"), F.col("w2"), F.col("w3")
    turned = phrases.select("lang", "w1", "w2", "w3", "f", F.when(w3 != "", w3).when(w2 != "", w2).otherwise(w1).alias("v1"), F.when(w3 != "", w2).when(w2 != "", w1).otherwise("").alias("v2"), F.when(w3 != "", w1).otherwise("").alias("v3"))
    return merged(turned, ["v1", "v2", "v3"], ["r1", "r2", "left"]).drop("v1", "v2", "v3")
