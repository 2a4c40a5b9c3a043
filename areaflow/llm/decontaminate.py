"""Benchmark decontamination by suffix arrays over the training texts.

Each task cuts its documents into shards of some SHARD_WORDS words. A shard holds its words as numbers, and the suffix
array: every position, in the order of the words from there on. The array is built by doubling, only positions whose
order is still open are sorted again, and it is exact to the depth of the longest test item, which is all that a
search for an item's suffixes can tell apart. A shard is searched by all blocks of items where it was built, and then
let go: shards as rows of a table, of several MB each, take more memory in Spark's readers and writers than here. What
is found is stored, so that it outlives lost executors.

Every suffix of every item is looked up in every shard by binary search, all suffixes of a block of items at once, word
by word: the positions of a prefix are a range of the array, which the next word narrows. Ranges of a whole window
give the words of documents that are hit; the last range that is not empty is the longest verbatim match of a suffix,
with its locations. No document is shuffled, and no text but the blocks of items is sent to tasks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.llm.common import saved

#: Words of a window, words of a shard (a longer document is a shard of its own), bytes of a block of items, and
#: positions that a search lists at a time.
WINDOW, SHARD_WORDS, BLOCK_BYTES, LISTED = 10, 1 << 19, 8 << 20, 1 << 21
#: Words before A-Z become a-z, as a Java pattern.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of words (0-9, a-z, all beyond ASCII); A-Z become a-z, all others a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a row of numbers of at least 0, ordered by the `depth` numbers from there on at least; beyond the
    end stands something smaller than any number."""
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(ids.max() + 1).bit_length())
    width = max(1, min(62 // bits, depth))
    padded = np.concatenate((ids.astype(np.int64) + 1, np.zeros(width, dtype=np.int64)))
    key = np.zeros(n, dtype=np.int64)
    for j in range(width):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key)
    sorted_key, at = key[order], np.arange(n)
    rank = np.empty(n, dtype=np.int64)  # the place of the first position of equal ones
    while True:
        new = np.ones(len(at), dtype=bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        rank[order[at]] = at[first]
        if width >= depth:
            return order
        last = np.append(new[1:], True)
        at, starts = at[~(new & last)], at[first][~(new & last)]
        if not len(at):
            return order
        beyond = order[at] + width
        following = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = starts * (n + 1) + following  # starts rise, so equal ones stay where they are
        place = np.argsort(key)
        order[at], sorted_key = order[at][place], key[place]
        width *= 2


@dataclass
class Items:
    """A block of test items: keys, all their words one after another as places in `names`, and where items end."""

    keys: list[str | None]
    names: list[bytes]
    words: np.ndarray
    ends: np.ndarray


def blocks(items: DataFrame, key: str, text: str) -> tuple[list[Broadcast[Items]], int]:
    """Items with words, as text keys, dealt by key into blocks of about BLOCK_BYTES; and the most words of an item, 1 at least."""
    rows = saved(items.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")), "leak-items")
    total = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.max(F.regexp_count("text", F.lit(WORDS))).alias("longest")).first()
    parts = max(1, math.ceil((total["bytes"] or 0) / BLOCK_BYTES))
    of = F.pmod(F.xxhash64("key"), F.lit(parts))
    return [rows.sparkSession.sparkContext.broadcast(collected(rows.filter(of == b))) for b in range(parts)], max(total["longest"] or 0, 1)


def collected(block: DataFrame) -> Items:
    numbers: dict[bytes, int] = defaultdict(lambda: len(numbers))
    keys, words, ends = [], [], []
    for row in sorted(block.collect(), key=lambda r: (r["key"] is None, r["key"] or "", r["text"])):
        found = words_of(row["text"])
        if found:
            keys.append(row["key"])
            words += [numbers[w] for w in found]
            ends.append(len(words))
    return Items(keys, list(numbers), np.array(words, dtype=np.int64), np.array(ends, dtype=np.int64))


@dataclass
class Shard:
    """Documents of a task: their keys and ends (in words, a 0 stands after each), the numbers of words from 1, the words
    as numbers and the suffix array (32 bits both)."""

    keys: pa.Array
    ends: np.ndarray
    numbers: dict[bytes, int]
    ids: np.ndarray
    suffixes: np.ndarray

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1]))


def shards(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[Shard]:
    """The documents (key, text) of a task as shards, in their order; one is in memory at a time."""
    keys: list[pa.Array] = []
    ends: list[int] = []
    ids: list[np.ndarray] = []
    numbers: dict[bytes, int] = defaultdict(lambda: len(numbers) + 1)
    size = 0

    def shard() -> Shard:
        row = np.concatenate(ids)
        return Shard(pa.concat_arrays(keys), np.array(ends, dtype=np.int64), numbers, row, suffix_array(row, depth).astype(np.int32))

    for batch in batches:
        start = 0
        for k, words in enumerate(map(words_of, (t.as_py() for t in batch.column(1)))):
            if ends and size + len(words) >= SHARD_WORDS:
                if k > start:
                    keys.append(batch.column(0).slice(start, k - start))
                yield shard()
                keys, ends, ids, size, start = [], [], [], 0, k
                numbers.clear()
            row = np.zeros(len(words) + 1, dtype=np.int32)
            row[:-1] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
            ids.append(row)
            size += len(row)
            ends.append(size)
        if batch.num_rows > start:
            keys.append(batch.column(0).slice(start))
    if ends:
        yield shard()


def in_turn(shared: list[Broadcast[Items]]) -> Iterator[Items]:
    """Blocks of items; where there are several, a task holds one of them at a time."""
    for block in shared:
        yield block.value
        if len(shared) > 1 and getattr(block, "_path", None):  # else it cannot be read again
            vars(block).pop("_value", None)


@dataclass
class Ranges:
    """Per suffix of the items: its item, its place there, the words matched at most, and the range of the suffix array
    in which they are; the same for the windows that occur, with their words."""

    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    windows: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def search(shard: Shard, items: Items, window: int) -> Ranges:
    """Look up every suffix of the items, all at once, by binary search for one word more each time."""
    test = np.array([shard.numbers.get(w, -1) for w in items.names], dtype=np.int64)[items.words]
    begins = np.concatenate(([0], items.ends[:-1]))
    item = np.repeat(np.arange(len(items.ends)), items.ends - begins)
    place = np.arange(len(test)) - begins[item]
    end, least = items.ends[item], np.minimum(items.ends - begins, window)[item]
    low, high = np.zeros(len(test), dtype=np.int64), np.full(len(test), len(shard.ids))
    length = np.zeros(len(test), dtype=np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    open_, depth = np.arange(len(test)), 0
    while len(open_):
        open_ = open_[open_ + depth < end[open_]]
        word = test[open_ + depth]

        def bound(lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
            """The first place of the range whose word is at least the suffix's (after: beyond it)."""
            lo, hi = lo.copy(), hi.copy()
            while (going := lo < hi).any():
                mid = (lo + hi) >> 1
                at = shard.suffixes[np.minimum(mid, len(shard.ids) - 1)] + depth
                there = np.where(at < len(shard.ids), shard.ids[np.minimum(at, len(shard.ids) - 1)], -1)
                right = going & ((there <= word) if after else (there < word))
                lo, hi = np.where(right, mid + 1, lo), np.where(going & ~right, mid, hi)
            return lo

        lo = bound(low[open_], high[open_], False)
        hi = bound(lo, high[open_], True)
        some = (lo < hi) & (word > 0)
        open_, lo, hi = open_[some], lo[some], hi[some]
        depth += 1
        low[open_], high[open_], length[open_] = lo, hi, depth
        full = least[open_] == depth
        found.append((item[open_[full]], lo[full], hi[full], np.full(int(full.sum()), depth)))
    empty = np.zeros(0, dtype=np.int64)
    windows = tuple(np.concatenate(c) for c in zip(*found)) if found else (empty,) * 4
    return Ranges(item, place, length, low, high, windows)


def listed(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers of ranges in turn, about LISTED at a time: (range, number). A long range comes in several parts."""
    k, start = 0, int(low[0]) if len(low) else 0
    while k < len(low):
        rows, numbers, room = [], [], LISTED
        while k < len(low) and room > 0:
            stop = min(int(high[k]), start + room)
            rows.append(np.full(stop - start, k))
            numbers.append(np.arange(start, stop))
            room -= max(stop - start, 1)
            if stop == high[k]:
                k += 1
                start = int(low[k]) if k < len(low) else 0
            else:
                start = stop
        yield np.concatenate(rows), np.concatenate(numbers)


def hits(shard: Shard, found: Ranges) -> tuple[np.ndarray, np.ndarray]:
    """Which words of the shard are in an occurrence of a window, and the pairs (document, item) of windows there."""
    item, low, high, words = found.windows
    marks = np.zeros(len(shard.ids) + 1, dtype=np.int64)
    once = np.unique(np.stack((low, high, words)), axis=1) if len(low) else np.zeros((3, 0), dtype=np.int64)
    for k, at in listed(once[0], once[1]):
        position = shard.suffixes[at]
        np.add.at(marks, position, 1)
        np.add.at(marks, position + once[2][k], -1)
    pairs = [np.zeros((0, 2), dtype=np.int64)]
    for k, at in listed(low, high):
        pairs.append(np.unique(np.stack((shard.document(shard.suffixes[at]), item[k]), axis=1), axis=0))
    return marks.cumsum()[:-1] > 0, np.unique(np.concatenate(pairs), axis=0)


#: What the items hit in one document.
HITS = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def shard_hits(shard: Shard, shared: list[Broadcast[Items]], window: int, names: list[str]) -> pa.RecordBatch:
    """A row of HITS, after its key, for each document of a shard: what the items of all blocks hit there."""
    hit, of_item, keys = np.zeros(len(shard.ids), dtype=bool), [np.zeros(0, dtype=np.int64)], []
    for items in in_turn(shared):
        there, pairs = hits(shard, search(shard, items, window))
        hit |= there
        of_item.append(pairs[:, 0])
        keys.append(pa.array([items.keys[k] for k in pairs[:, 1]], pa.string()))
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    of, starts, documents = shard.document(first), shard.starts(), np.arange(len(shard.ends) + 1)
    spans = pa.StructArray.from_arrays([pa.array((v - starts[of]).astype(np.int32)) for v in (first, last)], fields=list(SPAN))
    named = np.concatenate(of_item)
    order = np.argsort(named, kind="stable")
    cut, where = (np.searchsorted(v, documents).astype(np.int32) for v in (of, named[order]))
    items_hit = pa.ListArray.from_arrays(pa.array(where), pa.concat_arrays(keys).take(pa.array(order)))
    return pa.RecordBatch.from_arrays([shard.keys, pa.array(shard.ends - starts - 1), pa.ListArray.from_arrays(pa.array(cut), spans), items_hit], names=names)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: key, n_words, n_hit (words in an occurrence of a window of an item), spans (runs of such words,
    from start up to before end), items (keys of items with a window there, as text and in that order, each once).

    A window is `window` words of an item in a row, or the whole of a shorter item. Windows end with the document.
    Null and empty texts have no words; such items match nothing, such documents give rows without hits. Repeated rows
    and null keys of documents each give a row; repeated rows of an item count as one, items with a null key hit words
    but are not named. Documents of any length are searched whole. An empty table gives no rows, without items nothing is
    hit. Columns other than those named are not read.
    """
    shared, depth = blocks(items, item, item_text)
    kind = T.StructType([T.StructField("_key", docs.schema[key].dataType), *T.StructType.fromDDL(HITS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, depth):
            yield shard_hits(shard, shared, window, kind.fieldNames())

    names = F.array_sort(F.array_distinct(F.array_compact("items")))
    return counted(saved(docs.select(key, text).mapInArrow(run, kind), "leak-hits"), key, "spans", names)


def counted(rows: DataFrame, key: str, spans: str, names: F.Column) -> DataFrame:
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(F.col("_key").alias(key), "n_words", n_hit.alias("n_hit"), F.col(spans).alias("spans"), names.alias("items"))


def without_leaks(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents without hits, of contamination(). Where a key occurs in several rows, all of them go if one is hit; rows
    with a null key go if any such row is hit."""
    hit = found.filter("n_hit > 0").select(F.col(key).alias("_hit_key")).distinct()
    return docs.join(hit, docs[key].eqNullSafe(hit["_hit_key"]), "left_anti")


def longest_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The longest verbatim matches of each item with words in common with a document, and where they are: item (as
    text), words (the length), item_start, key, start (in words of the item and the document). One row for each place
    of the longest match, ties included; items with a null key count as one."""
    shared, depth = blocks(items, item, item_text)
    kind = T.StructType([T.StructField("_key", docs.schema[key].dataType), *T.StructType.fromDDL("item string, words int, item_start int, start long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, depth):
            for items in in_turn(shared):
                found = search(shard, items, WINDOW)
                most = np.zeros(len(items.ends), dtype=np.int64)
                np.maximum.at(most, found.item, found.length)
                best = np.flatnonzero((found.length == most[found.item]) & (found.length > 0))
                for k, at in listed(found.low[best], found.high[best]):
                    position, suffix = shard.suffixes[at].astype(np.int64), best[k]
                    of = shard.document(position)
                    yield pa.RecordBatch.from_arrays(
                        [shard.keys.take(pa.array(of)), pa.array([items.keys[j] for j in found.item[suffix]], pa.string()),
                         pa.array(found.length[suffix].astype(np.int32)), pa.array(found.place[suffix].astype(np.int32)), pa.array(position - shard.starts()[of])],
                        names=kind.fieldNames(),
                    )

    rows = saved(docs.select(key, text).mapInArrow(run, kind), "leak-matches")
    most = rows.groupBy(F.col("item").alias("_item")).agg(F.max("words").alias("_most"))
    same = rows["item"].eqNullSafe(most["_item"]) & (rows["words"] == most["_most"])
    return rows.join(most, same).select("item", "words", "item_start", F.col("_key").alias(key), "start").distinct()
