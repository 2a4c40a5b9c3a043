"""Hidden Markov language model over whole texts, trained by Baum-Welch on all training texts.

Words of the corpus are counted exactly. Hidden states emit classes: the most frequent words are classes of their own,
all others share classes by their last bytes. Within a shared class every word of the corpus has its own expected
count in each state, so what is learnt grows with the vocabulary: a state emits a class, then a word of it by these
counts, smoothed by the word's share of the class (add-one); unknown words have a share that no state changes. Both
steps together are a distribution over all texts, and a text's likelihood is the exact forward recursion over its words.

Each text is encoded once: numbers of words in a bounded dictionary of frequent words, classes of the others, and
these words themselves. The latter meet their counts in joins (rare words have no hot keys by nature). A Baum-Welch
round is a pass over the encoded training texts: every task adds up expected counts, a grouped sum merges them, and
the new class parameters, of fixed size, go out again. The last round also sums the expected counts by word and state:
those of dictionary words go out with the model, those of all others stay a table that scoring joins. Where the rounds
start from follows from exact counts of neighbours over all training texts, in groups of classes (see started).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.llm.common import saved, words_of

#: Words that are classes of their own, shared classes of the others, and frequent words whose counts every task has.
OWN_CLASSES, SHARED_CLASSES, DICTIONARY = 8_192, 2_048, 200_000
STATES, FULL_ROUNDS = 6, 2  # packed() has room for six states
#: Weight, in expected counts, of a word's overall share of its class beside its counts in a state.
SHARE_WEIGHT = 20.0
#: Steps of one in which the states of a token outside the dictionary are counted, so that sums travel as small integers.
STEPS = 1024
#: Frequent classes that are groups of their own where neighbours are counted, all groups, and rounds over these counts.
OWN_GROUPS, GROUPS, START_ROUNDS = 448, 512, 100
#: Tokens that are in memory together (a longer text is taken alone), and words counted before a task hands them on.
BATCH_TOKENS, COUNTED = 1 << 18, 100_000
COMPRESSION = "zstd"  # of stored tables
END = b""  # no word is empty


def class_of(word: bytes) -> int:
    """Class of a word that has none of its own."""
    return OWN_CLASSES + zlib.crc32(word[-3:]) % SHARED_CLASSES


def counts_of(texts: DataFrame, text: str) -> DataFrame:
    """Exact counts (word binary, c) of the words of all texts, and of the ends of texts (the empty word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            words, n = list(held.keys()), list(held.values())
            for k in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(words[k : k + (1 << 16)], type=pa.binary()), pa.array(n[k : k + (1 << 16)], type=pa.int64())], names=["word", "c"])
            held.clear()

        for batch in batches:
            for t in batch.column(0):
                held.update(words_of(t.as_py()))
                held[END] += 1
                if len(held) > COUNTED:
                    yield from rows()
        yield from rows()

    return texts.select(text).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The dictionary (word to place, count and class), totals of tokens and words, and tokens and words by class."""

    places: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    words: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    def unknown(self) -> np.ndarray:
        """Share of the words that training texts do not have, by class (0 in classes of one word)."""
        return np.concatenate([np.zeros(OWN_CLASSES), 1 / (self.class_tokens + self.class_words + 1)])


def classes_of(classes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Classes of encoded words: places in the dictionary (with these classes), or its size plus the class of another word."""
    size = len(classes)
    return np.where(codes < size, classes[np.minimum(codes, size - 1)], codes - size)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Collects the dictionary (bounded by DICTIONARY) and one row per shared class."""
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # counts by their five highest bits: the lowest such count from which on all words fit into the dictionary
    bits = "greatest(length(bin(c)) - 5, 0)"
    found = counts.groupBy(F.expr(f"shiftleft(shiftright(c, {bits}), {bits})").alias("least")).count().collect()
    least, listed_words = 1 << 62, 0
    for r in sorted(found, key=lambda r: -r["least"]):
        listed_words += r["count"]
        if listed_words > DICTIONARY:
            break
        least = r["least"]
    top = counts.filter(F.col("c") >= least).toArrow()
    words, c = top.column("word").to_pylist(), top.column("c").to_numpy().astype(np.int64)
    order = sorted(range(len(words)), key=lambda k: (-c[k], words[k]))
    words, c = [words[k] for k in order], c[order]
    own = words[:OWN_CLASSES]
    if END not in own:  # the end of a text always has a class of its own
        own = [END, *own[: OWN_CLASSES - 1]]
    classes = {w: k for k, w in enumerate(own)}
    cls = np.array([classes[w] if w in classes else class_of(w) for w in words], dtype=np.int64)
    shared = T.LongType()
    named = pa.array(own, type=pa.binary())

    @F.arrow_udf(shared)
    def place(batch: pa.Array) -> pa.Array:
        return pa.array([class_of(w.as_py()) for w in batch], type=pa.int64())

    listed = counts.sparkSession.createDataFrame(pa.table({"word": named}))  # OWN_CLASSES rows
    rest = counts.join(F.broadcast(listed), "word", "left_anti").groupBy(place("word").alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    tokens, distinct = np.zeros(SHARED_CLASSES, dtype=np.int64), np.zeros(SHARED_CLASSES, dtype=np.int64)
    for r in rest.collect():  # SHARED_CLASSES rows at most
        tokens[r["k"] - OWN_CLASSES], distinct[r["k"] - OWN_CLASSES] = r["n"], r["v"]
    places = {w: k for k, w in enumerate(words)}
    if END not in places:
        places[END] = len(words)
        c, cls = np.append(c, 0), np.append(cls, classes[END])
    return Vocabulary(places, c, cls, int(total["n"] or 0), int(total["v"]), tokens, distinct)


def encoded(docs: DataFrame, text: str, vocab: Vocabulary) -> DataFrame:
    """Encode all texts: the columns of docs without the text, row, n_tokens, codes (32-bit numbers, see
    classes_of), known, base (log10 sum over dictionary words), and rare (the other words, in their order)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # bounded by DICTIONARY
    kind = "n_tokens long, codes binary, known long, base double, rare array<binary>"

    @F.arrow_udf(T.StructType.fromDDL(kind))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = shared.value
        place, end, size = v.places.get, v.places[END], len(v.classes)
        logs = np.log10((v.counts + 1) / (v.tokens + v.words + 1))
        seen = v.counts > 0
        for texts in batches:
            cols: dict[str, list] = {k.split()[0]: [] for k in kind.split(", ")}
            for t in texts:
                words = words_of(t.as_py())
                codes = np.append(np.fromiter(map(place, words, repeat(-1)), dtype=np.int64, count=len(words)), end)
                missing = np.flatnonzero(codes < 0)
                rare = [words[k] for k in missing.tolist()]
                at = codes[codes >= 0]
                codes[missing] = [size + class_of(w) for w in rare]
                row = (len(codes), codes.astype("<u4").tobytes(), int(seen[at].sum()), float(logs[at].sum()), rare)
                for c, x in zip(cols.values(), row):
                    c.append(x)
            types = [pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.list_(pa.binary())]
            yield pa.StructArray.from_arrays([pa.array(c, type=k) for c, k in zip(cols.values(), types)], list(cols))

    return docs.withColumn("_e", run.asNondeterministic()(F.col(text))).select(*[f"`{c}`" for c in docs.columns if c != text], F.monotonically_increasing_id().alias("row"), "_e.*")


@dataclass
class Model:
    """Start, transition and emission probabilities (states by classes)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Sequences:
    """Class sequences laid out by time: at each step the texts that go on are the first ones, by descending
    length."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths = lengths[self.order]
        self.active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), side="right")
        self.first = np.concatenate(([0], np.cumsum(self.active)))
        text = np.repeat(np.arange(len(lengths)), lengths)
        time = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        where = self.first[time] + text
        flat = np.concatenate([sequences[k] for k in self.order.tolist()] or [np.zeros(0, dtype=np.int64)])
        self.ids, self.text = np.empty(len(flat), dtype=np.int64), np.empty(len(flat), dtype=np.int64)
        self.where = where  # places of the tokens of all sequences, one after the other by descending length
        self.ids[where], self.text[where] = flat, text

    def forward(self, m: Model, keep: bool = False, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Log10 likelihood of each text in the order given, scales by token, and scaled forward values; `within` are
        further factors of the emissions, tokens (in the order of the sequences given) by states."""
        weight = m.emit.T[self.ids]
        if within is not None:
            weight[self.placed(within)] *= within
        scale = np.ones(len(self.ids))
        a = None
        for t, n in enumerate(self.active.tolist()):
            lo = int(self.first[t])
            a = (m.start if a is None else a[:n] @ m.move) * weight[lo : lo + n]
            s = a.sum(axis=1)
            a /= s[:, None]
            scale[lo : lo + n] = s
            if keep:
                weight[lo : lo + n] = a
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(self.text, weights=np.log10(scale), minlength=len(self.order))
        return out, scale, weight if keep else None

    def placed(self, tokens: np.ndarray) -> np.ndarray:
        """Places of the tokens of the sequences in the order they were given."""
        starts = np.cumsum(self.lengths) - self.lengths
        given = np.empty(len(self.lengths), dtype=np.int64)
        given[self.order] = starts
        sizes = np.empty(len(self.lengths), dtype=np.int64)
        sizes[self.order] = self.lengths
        return self.where[np.repeat(given - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(tokens))]

    def expected(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, moves and emissions."""
        start, moves, gamma = self.posterior(m)
        emits = np.stack([np.bincount(self.ids, weights=gamma[:, k], minlength=m.emit.shape[1]) for k in range(m.emit.shape[0])])
        return start, moves, emits

    def posterior(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts and moves, and the states' probabilities at each token."""
        _, scale, alpha = self.forward(m, keep=True)
        over = m.emit.T[self.ids]  # emission over scale; times the backward value below
        over /= scale[:, None]
        moves = np.zeros_like(m.move)
        gamma = np.ones_like(over)
        back = None
        for t in range(len(self.active) - 1, -1, -1):
            lo, n = int(self.first[t]), int(self.active[t])
            b = gamma[lo : lo + n]
            if back is not None:
                b[: len(back)] = back @ m.move.T
            over[lo : lo + n] *= b
            back = over[lo : lo + n]
            if t:
                moves += alpha[int(self.first[t - 1]) :][:n].T @ back
        gamma *= alpha
        moves *= m.move
        return gamma[: int(self.active[0]) if len(self.active) else 0].sum(axis=0), moves, gamma


def codes_of(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype="<u4").astype(np.int64)


def batches_of(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sequences of an Arrow batch in groups of bounded tokens, longest first, with their rows."""
    sequences = [codes_of(x) for x in column]
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    at = 0
    while at < len(order):
        total, to = 0, at
        while to < len(order) and (to == at or total + len(sequences[order[to]]) <= BATCH_TOKENS):
            total += len(sequences[order[to]])
            to += 1
        yield order[at:to], [sequences[k] for k in order[at:to]]
        at = to


def updated(start: np.ndarray, moves: np.ndarray, emits: np.ndarray, prior: np.ndarray) -> Model:
    """Probabilities from expected counts; every class keeps a little of its overall share in every state."""
    emits = emits + 10 * prior
    return Model((start + 1) / (start + 1).sum(), (moves + 1) / (moves + 1).sum(axis=1, keepdims=True), emits / emits.sum(axis=1, keepdims=True))


def prior_of(vocab: Vocabulary) -> np.ndarray:
    """Overall share of each class, add-one smoothed."""
    n = np.ones(OWN_CLASSES + SHARED_CLASSES)
    np.add.at(n, vocab.classes[vocab.classes < OWN_CLASSES], vocab.counts[vocab.classes < OWN_CLASSES])
    n[OWN_CLASSES:] += vocab.class_tokens
    return n / n.sum()


def group_of(classes: np.ndarray) -> np.ndarray:
    """Groups of classes: the most frequent ones alone, all others dealt over the rest."""
    return np.where(classes < OWN_GROUPS, classes, OWN_GROUPS + classes % (GROUPS - OWN_GROUPS))


def neighbours(train: DataFrame, vocabs) -> np.ndarray:
    """How often each group follows each (rows: the one before), counted exactly over all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, found = vocabs.value, np.zeros(GROUPS * GROUPS, dtype=np.int64)
        for batch in batches:
            for _, sequences in batches_of(batch.column(0)):
                groups = group_of(classes_of(classes, np.concatenate(sequences)))
                inside = np.ones(len(groups), dtype=bool)
                inside[np.cumsum([len(s) for s in sequences]) - 1] = False  # nothing follows the end of a text
                found += np.bincount((groups[:-1] * GROUPS + groups[1:])[inside[:-1]], minlength=len(found))
        met = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(found[met])], names=["pair", "c"])

    pairs = train.select("codes").mapInArrow(run, "pair int, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()  # GROUPS squared rows at most
    found = np.zeros(GROUPS * GROUPS)
    found[pairs.column("pair").to_numpy()] = pairs.column("c").to_numpy()
    return found.reshape(GROUPS, GROUPS)


def started(pairs: np.ndarray, prior: np.ndarray, seed: int) -> Model:
    """Where Baum-Welch starts from: states that explain the counts of neighbours best, by expectation maximisation over
    these counts alone. A class has its group's emissions, by its share of the group."""
    group = group_of(np.arange(len(prior)))
    share = np.bincount(group, weights=prior, minlength=GROUPS)
    start, move = np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
    emit = share * np.random.default_rng(seed).uniform(0.5, 1.5, (STATES, GROUPS))
    emit /= emit.sum(axis=1, keepdims=True)
    for _ in range(START_ROUNDS):
        both = start[:, None] * move
        ratio = pairs / np.maximum(emit.T @ both @ emit, 1e-300)
        before, after = both @ emit @ ratio.T, both.T @ emit @ ratio  # states by groups
        first = emit * before
        moves = both * (emit @ ratio @ emit.T)
        start, move, emit = (lambda m: (m.start, m.move, m.emit))(updated(first.sum(axis=1), moves, first + emit * after, share))
    return Model(start, move, (emit / share)[:, group] * prior)


def trained(train: DataFrame, vocab: Vocabulary, seed: int = 3) -> tuple[Model, np.ndarray, np.ndarray, DataFrame]:
    """Baum-Welch over the encoded training texts (columns codes, rare). Gives the model of classes, the expected counts
    by state of classes and of dictionary words, and a table of those of all other words (word, e: its count, then steps)."""
    prior = prior_of(vocab)
    vocabs = train.sparkSession.sparkContext.broadcast(vocab.classes)  # bounded by DICTIONARY
    model = started(neighbours(train, vocabs), prior, seed)
    for k in range(FULL_ROUNDS):
        start, moves, emits, found, others = full_round(train, model, vocabs, by_word=k == FULL_ROUNDS - 1)
        model = updated(start, moves, emits, prior)
    listed = np.zeros((len(vocab.classes), STATES))
    mine = found.filter(f"number >= {len(prior)}").select("number", "e").toArrow()  # bounded by DICTIONARY
    if len(mine):
        listed[mine.column("number").to_numpy() - len(prior)] = mine.column("e").combine_chunks().flatten().to_numpy().reshape(-1, STATES)
    return model, emits, listed, others


def full_round(train: DataFrame, model: Model, vocabs, by_word: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame, DataFrame]:
    """Expected counts over all training texts, and two tables by state: (number, e) with one row for starts and each
    state's moves (numbers below zero), each class (its number) and, by word, each dictionary word of a shared class
    (place after all classes); and (word, e: its count, then steps) for each other word. Tasks send sums."""
    shared = train.sparkSession.sparkContext.broadcast(model)  # of fixed size
    classes = model.emit.shape[1]

    def rows(numbers: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        v = pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), STATES).cast(pa.list_(pa.float64()))
        return batch_of(pa.array(numbers, type=pa.int64()), pa.nulls(len(v), pa.binary()), v, pa.nulls(len(v), pa.list_(pa.int64())))

    def word_rows(words: list[pa.Array], steps: list[np.ndarray]) -> pa.RecordBatch:
        met, e = pa.concat_arrays(words).dictionary_encode(), np.concatenate(steps)
        k, size = met.indices.to_numpy(), len(met.dictionary)
        sums = [np.bincount(k, minlength=size), *(np.bincount(k, weights=e[:, j], minlength=size) for j in range(STATES))]
        flat = pa.array(np.stack(sums, axis=1).astype(np.int64).reshape(-1))
        n = pa.FixedSizeListArray.from_arrays(flat, 1 + STATES).cast(pa.list_(pa.int64()))
        return batch_of(pa.nulls(len(n), pa.int64()), met.dictionary, pa.nulls(len(n), pa.list_(pa.float64())), n)

    def batch_of(*columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(columns), names=["number", "word", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, vocabs.value
        size = len(known)
        head, emits, listed = np.zeros((1 + STATES, STATES)), np.zeros((classes, STATES)), np.zeros((size if by_word else 0, STATES))
        words: list[pa.Array] = []
        held: list[np.ndarray] = []
        tokens = 0
        for batch in batches:
            others, ends = batch.column(1).flatten(), np.cumsum(pc.list_value_length(batch.column(1)).to_numpy())
            for at, sequences in batches_of(batch.column(0)):
                codes = np.concatenate(sequences)
                laid = Sequences([classes_of(known, s) for s in sequences])
                start, moves, gamma = laid.posterior(m)
                head += np.concatenate([start[None], moves])
                at_token = laid.placed(codes)
                mine = codes < size
                steps = np.rint(gamma[at_token[~mine]] * STEPS)
                gamma[at_token[~mine]] = steps / STEPS
                for k in range(STATES):
                    emits[:, k] += np.bincount(laid.ids, weights=gamma[:, k], minlength=classes)
                if not by_word:
                    continue
                at_token = at_token[mine]
                for k in range(STATES):
                    listed[:, k] += np.bincount(codes[mine], weights=gamma[at_token, k], minlength=size)
                words.append(others.take(pa.array(np.concatenate([np.arange(ends[r - 1] if r else 0, ends[r]) for r in at]))))
                held.append(steps.astype(np.int32))
                tokens += len(steps)
                if tokens > COUNTED:
                    yield word_rows(words, held)
                    words, held, tokens = [], [], 0
        met = np.flatnonzero(emits.sum(axis=1) > 0)
        yield rows(np.concatenate([np.arange(1 + STATES) - 1 - STATES, met]), np.concatenate([head, emits[met]]))
        if by_word:
            met = np.flatnonzero((listed.sum(axis=1) > 0) & (known >= OWN_CLASSES))
            yield rows(classes + met, listed[met])
        if tokens:
            yield word_rows(words, held)

    found = train.select("codes", "rare").mapInArrow(run, "number long, word binary, v array<double>, n array<long>")
    if by_word:
        found = saved(found, "hmm-found", COMPRESSION)

    def summed(rows: DataFrame, key: str, values: list[Column]) -> DataFrame:
        sums = rows.groupBy(key).agg(*[F.sum(v).alias(f"e{k}") for k, v in enumerate(values)])
        return sums.select(key, F.array(*[f"e{k}" for k in range(len(values))]).alias("e"))

    merged = saved(summed(found.filter("word is null"), "number", [F.col("v")[k] for k in range(STATES)]), "hmm-expected")
    # tasks have summed what they could: rare words travel as they are, in few integers
    sent = found.filter("word is not null").select("word", packed(F.col("n")).alias("n")).repartition("word")
    words = summed(sent, "word", [part_in(F.col("n"), k) for k in range(1 + STATES)])
    mine = merged.filter(f"number < {classes}").select("number", "e").toArrow()  # of fixed size
    number, values = mine.column("number").to_numpy(), np.zeros((0, STATES))
    if len(mine):
        values = mine.column("e").combine_chunks().flatten().to_numpy().reshape(-1, STATES)
    head, emits = np.zeros((1 + STATES, STATES)), np.zeros((STATES, classes))
    head[number[number < 0] + 1 + STATES] = values[number < 0]
    emits[:, number[number >= 0]] = values[number >= 0].T
    return head[0], head[1:], emits, merged, words


def packed(e: Column) -> Column:
    """The count of a word and its steps by state as few integers: two, in parts of 8 and 18 bits, up to a count of 255;
    above, all of them below zero (-1 less each)."""
    at = lambda k: F.shiftleft(e[k], 18 * (2 - (k - 1) % 3))
    return F.when(e[0] < 256, F.array(F.shiftleft(e[0], 54) + at(1) + at(2) + at(3), at(4) + at(5) + at(6))).otherwise(F.transform(e, lambda x: -1 - x))


def part_in(v: Column, k: int) -> Column:
    """The count (k is 0) or the steps of a state (k from 1) in a packed word."""
    small = F.shiftright(v[0], 54) if k == 0 else F.shiftright(v[(k - 1) // 3], 18 * (2 - (k - 1) % 3)).bitwiseAND(F.lit((1 << 18) - 1))
    return F.when(v[0] < 0, -1 - F.get(v, F.lit(k))).otherwise(small)


def unpacked(v: np.ndarray) -> np.ndarray:
    """Counts and steps of packed words that follow each other."""
    large = v < 0
    head = np.where(large, (np.cumsum(large) - 1) % (1 + STATES), (np.cumsum(~large) - 1) % 2) == 0
    large_word, pairs = large[head], v[~large].reshape(-1, 2)
    out = np.empty((len(large_word), 1 + STATES), dtype=np.int64)
    out[large_word] = -1 - v[large].reshape(-1, 1 + STATES)
    out[~large_word] = np.concatenate([pairs[:, :1] >> 54, *((pairs[:, k // 3, None] >> 18 * (2 - k % 3)) & 0x3FFFF for k in range(STATES))], axis=1)
    return out


def within_class(e: np.ndarray, c: np.ndarray, unknown: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Probabilities of words with counts c in their classes by state, from the expected counts by state of the words
    and of the classes, and the classes' shares of unknown words (which count 0)."""
    u = unknown[:, None]
    known = ((1 - u) * e + SHARE_WEIGHT * u * (c[:, None] + 1)) / (whole + SHARE_WEIGHT)
    return np.where(c[:, None] > 0, known, u)


def scored(docs: DataFrame, allowed: Column, text: str = "text") -> DataFrame:
    """Train on the texts for which `allowed` holds and score all: adds n_tokens, n_known, train_tokens, base_score
    (add-one unigram) and score (this model), both log10 probabilities of the whole text and its end.

    A null or empty text is its end alone. Without training texts all words are unknown. Repeated rows count as often
    as they occur. An empty table gives no rows.
    """
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    names = {f"_in{k}": c for k, c in enumerate(docs.columns) if c not in (*new, text)}
    own = list(names)
    tagged = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in names.items()], F.col(text).alias("_text"), F.coalesce(allowed, F.lit(False)).alias("_train"))
    counts = saved(counts_of(tagged.filter("_train"), "_text"), "hmm-counts", COMPRESSION)
    vocab = vocabulary(counts)
    data = saved(encoded(tagged, "_text", vocab), "hmm-encoded", COMPRESSION)
    model, whole, listed, others = trained(data.filter("_train"), vocab)
    unknown = vocab.unknown()
    factors = within_class(listed, vocab.counts, unknown[vocab.classes], whole.T[vocab.classes])
    factors[vocab.classes < OWN_CLASSES] = 1.0
    shared = docs.sparkSession.sparkContext.broadcast((model, whole, unknown, factors, vocab.classes))  # bounded by DICTIONARY

    @F.arrow_udf(T.DoubleType())
    def forward(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        m, whole, unknown, factors, classes = shared.value
        size = len(classes)
        for column, found in batches:
            out = np.zeros(len(column))
            for rows, sequences in batches_of(column):
                codes = np.concatenate(sequences)
                mine = codes < size
                ids = np.where(mine, classes[np.minimum(codes, size - 1)], codes - size)
                within = factors[np.minimum(codes, size - 1)]
                if not mine.all():
                    v = unpacked(np.concatenate([found[r].values.to_numpy() for r in rows if found[r].is_valid]))
                    within[~mine] = within_class(v[:, 1:] / STEPS, v[:, 0], unknown[ids[~mine]], whole.T[ids[~mine]])
                ends = np.cumsum([len(s) for s in sequences])[:-1]
                out[rows] = Sequences(np.split(ids, ends)).forward(m, within=within)[0]
            yield pa.array(out)

    # every other word of the corpus: its count and its expected counts by state
    known = others.select("word", packed(F.col("e")).alias("v"))
    rare = data.filter(F.size("rare") > 0).select("row", F.posexplode("rare").alias("pos", "word"))
    none = F.array(*[F.lit(0).cast("long")] * 2)
    met = rare.join(known, "word", "left").select("row", "pos", F.coalesce("v", none).alias("v")).repartition("row")
    c = part_in(F.col("v"), 0)
    summed = met.groupBy("row").agg(
        F.count_if(c > 0).alias("r_known"),
        F.sum(F.log10((c + 1) / F.lit(float(vocab.tokens + vocab.words + 1)))).alias("r_base"),
        F.flatten(F.array_sort(F.collect_list(F.struct("pos", "v")))["v"]).alias("r_v"),  # of one text
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return data.select(*own, "row", "n_tokens", "known", "base", "codes").join(summed, "row", "left").select(
        *own, "n_tokens", (F.col("known") + zero("r_known")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("r_base")).alias("base_score"), forward("codes", "r_v").alias("score"),
    ).toDF(*names.values(), *new)
