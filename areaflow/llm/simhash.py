"""Near copies by SimHash: fingerprints, and a binary-trie self-join that finds all pairs within a Hamming distance.

The trie is walked as pairs of nodes: both nodes of a pair split at the next bit, a pair whose branches differ
adds one to its differing bits, and a pair over the error budget is dropped with all that lies below it; so is a
pair all of whose rows are linked already. To deal the walk out, fingerprints meet by equal heads, the four blocks of
their 64 bits (`block_heads`): of two fingerprints with at most three differing bits one block is equal, so the walk
misses no link.
A subtrie with too many fingerprints is dealt out once more, by pairs of nodes a few bits below its root. Tasks return
a spanning star for each linked set, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.llm.common import components, join_sets, saved, whole_groups, words_of

BLOCKS, BLOCK_BITS = 4, 16
#: Fingerprints of one subtrie before it is dealt out further, and the bits by which that is done at most.
SUBTRIE_ROWS, SPLIT_BITS = 1 << 19, 8
#: Pairs of nodes in one step of the walk, and the size below which a pair of nodes is compared directly.
STEP_PAIRS, SMALL = 1 << 18, 8
SIGN = np.uint64(1 << 63)


def remixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further independent hashes, by multiplying and folding; the first are the hashes themselves."""
    if not word:
        return hashes
    x = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * word & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: list[bytes], shingle: int, seed: int = 42) -> np.ndarray:
    """Hashes of all shingles, repeats included; a text with fewer words is one shingle."""
    n = max(1, len(words) - shingle + 1)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n == 1:
        return np.array([digest(line, seed)], dtype="<u8")
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8")


def fingerprint(words: list[bytes], shingle: int, seed: int = 42, wide: int = 1) -> list[int]:
    """Majority vote by bit over the hashes of all shingles, repeats included; zeros without words."""
    return majority(shingle_hashes(words, shingle, seed), wide) if words else [0] * wide


def majority(hashes: np.ndarray, wide: int) -> list[int]:
    out, n = [], len(hashes)
    for k in range(wide):
        ones, own = np.zeros(64, dtype=np.int64), remixed(hashes, k)
        for lo in range(0, n, 1 << 14):
            part = own[lo : lo + (1 << 14)]
            ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]))
    return out


def fingerprints(text: Column, shingle: int = 3, seed: int = 42, wide: int = 1) -> Column:
    """SimHash of a text column as an array of longs of 64 bits each."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def run(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint(words_of(t.as_py()), shingle, seed, wide) for t in texts], dtype=np.uint64).reshape(-1)
        return pa.FixedSizeListArray.from_arrays(pa.array(prints.view(np.int64)), wide).cast(pa.list_(pa.int64()))

    return run.asNondeterministic()(text)


def block_heads(fp: Column) -> Column:
    """The four blocks of a 64-bit fingerprint."""
    return F.array(*[F.shiftrightunsigned(fp[0], BLOCK_BITS * k).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for k in range(BLOCKS)])


class Trie:
    """The walk over a block of rows sorted by group, side and fingerprint (words of 64 bits, the highest first).

    `join` links rows that differ in at most `budget` bits: within a group, or between the sides of a group. `root`
    then holds the smallest row reachable from each row.
    """

    def __init__(self, words: list[np.ndarray], budget: int) -> None:
        self.words, self.budget = words, budget
        self.root = np.arange(len(words[0]))

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join the sets of the row pairs that are within the budget."""
        root = self.root
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        bits = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int16) for w in self.words)
        join_sets(root, i[bits <= self.budget], j[bits <= self.budget])

    def direct(self, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> None:
        n = (a1 - a0) * (b1 - b0)
        pair = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[pair]
        self.link(a0[pair] + at // width, b0[pair] + at % width)

    def join(self, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> None:
        """Walk the pairs of nodes [a0, a1) and [b0, b1), rows of one group each."""
        self.link(np.repeat(b0, a1 - a0), np.concatenate([np.arange(x, y) for x, y in zip(a0, a1)] or [a0]))
        self.link(np.repeat(a0, b1 - b0), np.concatenate([np.arange(x, y) for x, y in zip(b0, b1)] or [b0]))
        todo = [(64 * len(self.words) - 1, a0, a1, b0, b1, np.zeros(len(a0), dtype=np.int16))]
        while todo:
            bit, a0, a1, b0, b1, errors = todo.pop()
            change = np.concatenate(([0], np.cumsum(self.root[1:] != self.root[:-1])))
            apart = (change[a1 - 1] != change[a0]) | (change[b1 - 1] != change[b0]) | (self.root[a0] != self.root[b0])
            small = apart & (((a1 - a0) * (b1 - b0) <= SMALL) | (bit < 0))
            if small.any():
                self.direct(a0[small], a1[small], b0[small], b1[small])
            a0, a1, b0, b1, errors = (x[apart & ~small] for x in (a0, a1, b0, b1, errors))
            if not len(a0):
                continue
            one = (self.words[len(self.words) - 1 - bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
            zeros = np.concatenate(([0], np.cumsum(one == 0)))
            am, bm, same = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0], (a0 == b0) & (a1 == b1)
            children = [(a0, am, b0, bm, errors), (am, a1, bm, b1, errors), (a0, am, bm, b1, errors + 1)]
            children.append(tuple(x[~same] for x in (am, a1, b0, bm, errors + 1)))
            a0, a1, b0, b1, errors = (np.concatenate(x) for x in zip(*children))
            keep = (a0 < a1) & (b0 < b1) & (errors <= self.budget) & ~((a0 == b0) & (a1 == b1) & (a1 - a0 == 1))
            parts = [x[keep] for x in (a0, a1, b0, b1, errors)]
            for k in range(0, len(parts[0]), STEP_PAIRS):
                todo.append((bit - 1, *(x[k : k + STEP_PAIRS] for x in parts)))


def linked(prints: DataFrame, heads: Column, wide: int, budget: int) -> DataFrame:
    """Links (a, b) between the ids of distinct fingerprints (id long, fp array of `wide` longs): a spanning star of
    every set that pairs within the budget connect, for each head."""
    values = [F.col("fp")[k].bitwiseXOR(F.lit(-(2**63))).alias(f"w{k}") for k in range(wide)]  # in unsigned order
    rows = prints.select("id", *values, F.posexplode(heads).alias("head", "at"))
    full = rows.groupBy("head", "at").count().filter(F.col("count") > SUBTRIE_ROWS)
    depth = F.least(F.lit(SPLIT_BITS), F.ceil(F.log2(F.col("count") / SUBTRIE_ROWS)) + 1).cast("int")
    masks = [[m for m in range(1 << d) if m.bit_count() <= budget] for d in range(SPLIT_BITS + 1)]
    rows = rows.join(full.select("head", "at", depth.alias("depth")), ["head", "at"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    rows = rows.withColumn("mask", F.explode(F.element_at(F.array(*[F.array(*map(F.lit, m)) for m in masks]), F.col("depth") + 1)))
    # the first `depth` bits of the fingerprint
    rows = rows.withColumn("node", F.expr("cast(shiftright(shiftrightunsigned(w0, 1), 63 - depth) as int)"))
    rows = rows.withColumn("low", F.least("node", F.col("node").bitwiseXOR(F.col("mask"))))
    rows = rows.withColumn("side", (F.col("node") != F.col("low")).cast("int"))
    group, names = ["head", "at", "low", "mask"], [f"w{k}" for k in range(wide)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, group, 1 << 17):
            walk = Trie([t.column(w).to_numpy().view(np.uint64) ^ SIGN for w in names], budget)
            lo, hi = starts[:-1], starts[1:]
            first = np.concatenate(([0], np.cumsum(t.column("side").to_numpy() == 0)))
            cut = lo + first[hi] - first[lo]
            own = t.column("mask").to_numpy()[lo] == 0
            nodes = (lo, np.where(own, hi, cut), np.where(own, lo, cut), hi)
            there = (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & (hi - lo > 1)
            walk.join(*(x[there] for x in nodes))
            # the smallest id is the centre of a star, so that the stars of different heads share their links
            ids = t.column("id").to_numpy()
            centre = ids.copy()
            np.minimum.at(centre, walk.root, ids)
            centre = centre[walk.root]
            child = np.flatnonzero(ids != centre)
            pair = [pa.array(ids[child]), pa.array(centre[child])]
            yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])

    return rows.repartition(*group).sortWithinPartitions(*group, "side", *names).select(*group, "side", "id", *names).mapInArrow(run, "a long, b long")


def nodes_of(base: DataFrame) -> DataFrame:
    """Nodes (id, fp, key, row: of the smallest key) of a table (key, row, fp), one per distinct fp. Null keys come last."""
    return saved(base.groupBy("fp").agg(smallest().alias("first"), F.min("row").alias("id")).select("id", "fp", "first.*"), "simhash-nodes")


def smallest() -> Column:
    return F.min_by(F.struct("key", "row"), F.struct(F.col("key").isNull(), "key", "row"))


def grouped(nodes: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with root (id of their component), and (root, key, row) of the smallest key of every component."""
    rooted = nodes.join(roots.withColumnRenamed("v", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    return rooted, rooted.groupBy("root").agg(smallest().alias("first")).select("root", "first.*")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, budget: int = 3) -> DataFrame:
    """One row per document: key, fp (64-bit fingerprint as a long) and component_id (smallest key of the documents
    reachable by links of at most `budget` differing bits; at most three, see block_heads).

    A null or blank text has fingerprint zero and is linked like any other. Null keys are never the smallest unless
    a component has no other; repeated rows are documents of their own. An empty table gives no rows.
    """
    if budget >= BLOCKS:
        raise ValueError("four blocks find links of at most three differing bits")
    base = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), fingerprints(F.col(text), shingle).alias("fp"))
    base = saved(base, "simhash-prints")
    nodes = nodes_of(base)
    nodes, owners = grouped(nodes, components(linked(nodes.select("id", "fp"), block_heads(F.col("fp")), 1, budget), "simhash"))
    found = nodes.select("fp", "root").join(owners.select("root", F.col("key").alias("component_id")), "root").drop("root")
    return base.join(found, "fp").select(F.col("key").alias(key), F.col("fp")[0].alias("fp"), "component_id")


def hex_print(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, budget: int = 3) -> DataFrame:
    """The documents that stay: of each component of near_copies() the one with the smallest key (of rows with that key
    the first; null keys come last), with the columns of the input. Texts without words are copies of each other. An
    empty table gives no rows.
    """
    if budget >= BLOCKS:
        raise ValueError("four blocks find links of at most three differing bits")
    names = [f"_in{k}" for k in range(len(docs.columns))]
    at = lambda c: F.col(names[docs.columns.index(c)])
    whole = docs.toDF(*names).withColumn("fp", fingerprints(at(text), shingle)).withColumn("row", F.monotonically_increasing_id())
    whole = saved(whole, "simhash-docs")
    nodes = nodes_of(whole.select(at(key).alias("key"), "row", "fp"))
    _, owners = grouped(nodes, components(linked(nodes.select("id", "fp"), block_heads(F.col("fp")), 1, budget), "simhash"))
    return whole.join(owners.select("row"), "row", "left_semi").select(*names).toDF(*docs.columns)
