"""Groups of spelling variants: words one edit apart, found with k-d trees over letter counts.

A word is a point, its letter counts. One replaced letter moves the point by one up and one down (L1 distance two, the
length stays), one inserted letter by one up (L1 distance one, the next length). So for every pair of lengths (l, l)
and (l, l + 1) a range search finds the candidates, and comparing the letters in order decides.

There is one tree for every length. Its upper part is fitted to a bounded sample of the words and sent to all tasks;
its leaves are cells, and every word belongs to one cell. A word searches each cell whose box the search cannot prune
(cells of its own length from its own on, so that a pair is met once, and all of the next length). The words of a cell
and those that search it meet in one group; a cell that got more than CELL_WORDS words is dealt into parts, each
searched by all. In a group the tree goes on: the task builds the lower part over the words of the cell, and walks it
with all searching words at once. Searches that reach a group stream through, only the cell's own words are held.

Forms are then joins: every word's best neighbour, and roots by halving the way until all have arrived (a form has at
least twice the occurrences of its word, so ways are short).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow.llm.common import part_of, saved

#: Words that take part: their least length and occurrences; and how much commoner a form is than its word.
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: One in DROPS runs loses a letter.
DROPS = 97
#: Words that the upper trees are fitted to (about; at most twice as many), and words of a cell.
SAMPLE_WORDS, CELL_WORDS = 1 << 16, 1 << 13
#: Words of a leaf of the lower trees, searches dealt at a time, letters compared at a time, pairs added up at a time, and
#: words whose counts a task holds.
LEAF_WORDS, SEARCHES, COMPARED, PAIRS, HELD = 32, 2_048, 1 << 22, 1 << 19, 1 << 20
#: Letters as Latin-1 bytes (a-z, and U+00C0 to U+00FF), so that a word is one byte a letter.
LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], dtype=np.uint8)
LETTER = np.full(256, -1, dtype=np.int64)
LETTER[LETTERS] = np.arange(len(LETTERS))
#: UTF-8 bytes of runs; A-Z become a-z, other ASCII a blank. Of the others only C3 xx stays.
RUN_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
NO_LETTERS = re.compile(rb"[\xc0-\xc2\xc4-\xff][\x80-\xbf]*")


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of letters, lower-cased in A-Z, as UTF-8."""
    return NO_LETTERS.sub(b" ", (text or "").encode("utf-8", "surrogatepass").translate(RUN_BYTES)).split()


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", drops: int = DROPS) -> DataFrame:
    """Words with their occurrences: the runs of letters of the texts, a run of document d losing a letter where `drops`
    divides the crc32 of "d:run". Runs of a null key stay whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                start = None if k.as_py() is None else crc32(f"{k.as_py()}:".encode())
                for word, n in Counter(runs(t.as_py())).items():
                    if start is not None and (h := crc32(word, start)) % drops == 0:
                        letters = word.decode()
                        at = h % len(letters)
                        word = (letters[:at] + letters[at + 1 :]).encode()
                    total[word] += n
                if len(total) > HELD:
                    yield rows()
        if total:
            yield rows()

    found = docs.select(F.col(key).cast("string"), text).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(words: list[bytes], length: int) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), length)


def latin(words: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [w.encode("latin-1") for w in words.to_pylist()]


def points_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts of each word."""
    out = np.zeros((len(letters), len(LETTERS)), dtype=np.int32)
    step = max(1, COMPARED // max(1, letters.shape[1]))
    for lo in range(0, len(letters), step):
        some = LETTER[letters[lo : lo + step]] + np.arange(0, len(letters[lo : lo + step]) * len(LETTERS), len(LETTERS))[:, None]
        out[lo : lo + step] = np.bincount(some.ravel(), minlength=len(some) * len(LETTERS)).reshape(len(some), len(LETTERS))
    return out


@dataclass
class Node:
    """A split of a box: words with fewer than `cut` of a letter to the left, others to the right; low and high are the
    box's counts of that letter. A leaf has a number, and the places of its words where a tree holds words."""

    letter: int = -1
    cut: int = 0
    low: int = 0
    high: int = 1 << 30
    left: Node | None = None
    right: Node | None = None
    leaf: int = 0
    places: np.ndarray | None = None


def tree(points: np.ndarray, most: float) -> Node:
    """A k-d tree over letter counts: boxes are cut near the middle of their most varied letter, until they hold `most`
    points or only equal ones. Leaves are numbered from left to right."""
    root, leaves = Node(), 0
    stack = [(root, np.arange(len(points)), {})]
    while stack:
        node, places, box = stack.pop()
        own = points[places]
        spread = own.var(axis=0) if len(places) > most else np.zeros(1)
        if not spread.max(initial=0) > 0:
            node.leaf, node.places, leaves = leaves, places, leaves + 1
            continue
        node.letter = letter = int(spread.argmax())
        counts = own[:, letter]
        cuts = np.unique(counts)[1:]
        below = np.searchsorted(np.sort(counts), cuts)
        node.cut = cut = int(cuts[np.abs(below - len(counts) / 2).argmin()])
        node.low, node.high = low, high = box.get(letter, (0, 1 << 30))
        node.left, node.right = Node(), Node()
        stack.append((node.right, places[counts >= cut], {**box, letter: (cut, high)}))
        stack.append((node.left, places[counts < cut], {**box, letter: (low, cut - 1)}))
    return root


def reached(root: Node, points: np.ndarray, down: int) -> Iterator[tuple[Node, np.ndarray]]:
    """Leaves and the points that search them: those from which one letter up and at most `down` letters down lead into
    the leaf's box. Each step of the walk prunes all searches of a box together."""
    rows = np.arange(len(points))
    stack = [(root, rows, np.zeros(len(rows), dtype=np.int32), np.zeros(len(rows), dtype=np.int32))]
    while stack:
        node, rows, ups, downs = stack.pop()
        if node.left is None:
            yield node, rows
            continue
        count = points[rows, node.letter]
        more = downs + np.maximum(count - (node.cut - 1), 0) - np.maximum(count - node.high, 0)
        near = more <= down
        if near.any():
            stack.append((node.left, rows[near], ups[near], more[near]))
        more = ups + np.maximum(node.cut - count, 0) - np.maximum(node.low - count, 0)
        near = more <= 1
        if near.any():
            stack.append((node.right, rows[near], more[near], downs[near]))


def homes(root: Node, points: np.ndarray) -> np.ndarray:
    """The leaf of each point."""
    out = np.zeros(len(points), dtype=np.int32)
    stack = [(root, np.arange(len(points)))]
    while stack:
        node, rows = stack.pop()
        if node.left is None:
            out[rows] = node.leaf
            continue
        left = points[rows, node.letter] < node.cut
        stack += [(node.left, rows[left]), (node.right, rows[~left])]
    return out


def fit(words: DataFrame) -> dict[int, Node]:
    """The upper tree of each length, with about CELL_WORDS of all words in a leaf, from a bounded sample."""
    sample = latin(part_of(words.select("word"), F.col("word"), SAMPLE_WORDS).toArrow().column("word"))
    by_length: dict[int, list[bytes]] = {}
    for w in sorted(sample):
        by_length.setdefault(len(w), []).append(w)
    share = len(sample) / max(words.count(), 1)
    return {length: tree(points_of(letters_of(own, length)), max(16, CELL_WORDS * share)) for length, own in by_length.items()}


#: Roles in a group: words of the cell, then those that search it from the same length, then from one letter less.
OWN, SAME, SHORTER = 0, 1, 2
DEALT = "length int, cell int, role int, home int, word string, n long"


def dealt(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    """Every word to its own cell, and to each cell that it searches; home is the own cell where the length is the same."""
    shared = words.sparkSession.sparkContext.broadcast(trees)  # bounded by SAMPLE_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, whole = shared.value, Node()
        for batch in batches:
            for lo in range(0, batch.num_rows, SEARCHES):
                part = batch.slice(lo, SEARCHES)
                words = latin(part.column(0))
                lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
                for length in np.unique(lengths).tolist():
                    rows = np.flatnonzero(lengths == length)
                    points = points_of(letters_of([words[r] for r in rows], length))
                    home = homes(trees.get(length, whole), points)
                    found = [(rows, np.full(len(rows), length), home, np.full(len(rows), OWN), home)]
                    for role, other, down in ((SAME, length, 1), (SHORTER, length + 1, 0)):
                        for leaf, at in reached(trees.get(other, whole), points, down):
                            at = at[leaf.leaf >= home[at]] if role == SAME else at
                            found.append((rows[at], np.full(len(at), other), np.full(len(at), leaf.leaf), np.full(len(at), role), home[at]))
                    at, *columns = (np.concatenate(c) for c in zip(*found))
                    for k in range(0, len(at), 1 << 16):
                        some = slice(k, k + (1 << 16))
                        there = part.take(pa.array(at[some]))
                        yield pa.RecordBatch.from_arrays([*[pa.array(c[some].astype(np.int32)) for c in columns], there.column(0), there.column(1)], names=["length", "cell", "role", "home", "word", "n"])

    return words.select("word", "n").mapInArrow(run, DEALT)


def in_parts(rows: DataFrame) -> DataFrame:
    """Words of a cell dealt into parts of about CELL_WORDS, with every search in each of them. Words of the same cell
    search the parts after their own; within a part the task compares them itself."""
    parts = rows.filter(F.col("role") == OWN).groupBy("length", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL_WORDS)).cast("int").alias("parts"))
    mine = F.when((F.col("role") != SHORTER) & (F.col("home") == F.col("cell")), F.pmod(F.xxhash64("word"), "parts").cast("int"))
    met = rows.join(parts, ["length", "cell"]).withColumn("mine", mine)
    first = F.when(F.col("role") == OWN, F.col("mine")).when(F.col("mine").isNotNull(), F.col("mine") + 1).otherwise(0)
    last = F.when(F.col("role") == OWN, F.col("mine")).otherwise(F.col("parts") - 1)
    which = F.when(first <= last, F.sequence(first, last))
    return met.select("length", "cell", F.explode(which).alias("part"), "role", "word", "n")


def one_replaced(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a and b, of one length, that differ in one letter."""
    return np.nonzero((a[:, None, :] != b[None, :, :]).sum(axis=2) == 1)


def one_inserted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a and b, b one letter longer, that are equal without one letter of b: what they share at the front
    and at the back covers all of a."""
    length = a.shape[1]

    def run(apart: np.ndarray) -> np.ndarray:
        return np.where(apart.any(axis=2), apart.argmax(axis=2), length)

    front = run(a[:, None, :] != b[None, :, :-1])
    back = run((a[:, None, :] != b[None, :, 1:])[:, :, ::-1])
    return np.nonzero(front + back >= length)


class Cell:
    """The words of a group, in a lower tree, and the pairs found so far."""

    def __init__(self, length: int, words: list[bytes], counts: list[int]) -> None:
        self.length, self.words, self.counts = length, words, counts
        self.letters = letters_of(words, length)
        self.points = points_of(self.letters)
        self.tree = tree(self.points, LEAF_WORDS)

    def pairs(self, words: list[bytes], longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of (place in words, place in the cell) that are one edit apart, words being one letter shorter if `longer`."""
        letters = letters_of(words, self.length - longer)
        near = one_inserted if longer else one_replaced
        for leaf, rows in reached(self.tree, points_of(letters), 0 if longer else 1):
            step = max(1, COMPARED // (len(leaf.places) * self.length))
            for lo in range(0, len(rows), step):
                i, j = near(letters[rows[lo : lo + step]], self.letters[leaf.places])
                if len(i):
                    yield rows[lo : lo + step][i], leaf.places[j]


NEAR = "word string, n_near long, best long, form string"


def near_rows(words: list[bytes], counts: list[int], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Per word i the number of its j and the best of them: the commonest, then the first in order."""
    n = np.array(counts, dtype=np.int64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[j], -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    text = [w.decode("latin-1") for w in words]
    return pa.RecordBatch.from_arrays(
        [pa.array([text[k] for k in i[first]]), pa.array(np.diff(np.append(first, len(i)))), pa.array(n[j[first]]), pa.array([text[k] for k in j[first]])],
        names=["word", "n_near", "best", "form"],
    )


def neighbours(words: DataFrame) -> DataFrame:
    """From distinct words of letters with their n: word, n_near (words one edit away) and the best of them, by its n
    (largest first) and then in code-point order. Words without a neighbour have no row."""
    rows = in_parts(saved(dealt(words, fit(words)), "spelling-cells"))
    group = ["length", "cell", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        own: list[pa.RecordBatch] = []
        cell: Cell | None = None

        def met(words: list[bytes], counts: list[int], longer: bool, within: bool = False) -> Iterator[pa.RecordBatch]:
            """Compare words with the cell; pairs count for both sides."""
            names, numbers, base = [*cell.words, *words], [*cell.counts, *counts], len(cell.words)
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def rows() -> pa.RecordBatch:
                i, j = (np.concatenate(c) for c in zip(*held))
                held.clear()
                return near_rows(names, numbers, np.concatenate((i, j)), np.concatenate((j, i)))

            size = 0
            for i, j in cell.pairs(words, longer):
                i, j = (i[i < j], j[i < j]) if within else (i + base, j)
                held.append((i, j))
                size += len(i)
                if size > PAIRS:
                    yield rows()
                    size = 0
            if size:
                yield rows()

        def opened() -> Iterator[pa.RecordBatch]:
            """Build the cell of the words held, and compare them with each other."""
            nonlocal cell
            table = pa.Table.from_batches(own)
            cell = Cell(key[0], latin(table.column("word")), table.column("n").to_pylist())
            yield from met(cell.words, cell.counts, False, True)

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in (*group, "role")]
            new = np.zeros(batch.num_rows, dtype=bool)
            new[:1] = True
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            starts = np.append(np.flatnonzero(new), batch.num_rows)
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
                here, role, part = tuple(int(c[lo]) for c in columns[:3]), columns[3][lo], batch.slice(lo, hi - lo)
                if here != key:
                    if own and cell is None:
                        yield from opened()
                    key, own, cell = here, [], None
                if role == OWN:
                    own.append(part)
                    continue
                if not own:
                    continue  # no word of this cell is in this part
                if cell is None:
                    yield from opened()
                yield from met(latin(part.column("word")), part.column("n").to_pylist(), role == SHORTER)
        if own and cell is None:
            yield from opened()

    found = rows.repartition(*group).sortWithinPartitions(*group, "role").mapInArrow(run, NEAR)
    best = F.min(F.struct((-F.col("best")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form"), (-F.col("best.less")).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Add root: where the forms of a word lead in the end; the word itself if it has none. Each round doubles the way
    that all roots have gone, and only words on the way are joined."""
    named = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    ways = saved(named, "spelling-ways")
    while True:
        next_ = ways.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        longer = saved(ways.join(next_, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")), "spelling-ways")
        ways = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return forms.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of at least LEAST_LENGTH letters and LEAST_COUNT occurrences: word, form, root, n, n_near, form_n.

    Words are those of counted(). Two words are near if one inserted, deleted or replaced letter makes one the other. The
    form of a word is its near word of largest n (of equal n the first in code-point order) if that is at least RATIO times
    the word's own n, else null, as is form_n, its n. root is where forms lead in the end, the word itself without
    a form. Null and empty texts have no words; repeated rows count as often as they stand there; texts and words may be of
    any length. An empty table gives no rows. Columns other than those named are not read.
    """
    kept = (F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH)
    words = saved(counted(docs, key, text).filter(kept), "spelling-words")
    near = neighbours(words)
    enough = F.col("form_n") >= RATIO * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")
    )
    return with_roots(saved(forms, "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")
