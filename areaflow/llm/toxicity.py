"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and word beginnings (lower-case A-Z), as insults also occur inside compounds. The vector space
holds the terms whose share of the toxic examples is a multiple of that of the others, a bound that does not depend on
how many examples there are; a vector is log term frequency times inverse
document frequency, of length one. The index keeps, per term, the postings in blocks of consecutive examples and
each block's largest weight. A search adds those up to a bound for every block, opens more and more blocks in descending
order of their bound and stops when no bound reaches the k-th best cosine, so its result is that of comparing with
every example. Neighbours vote with weights cosine / (distance + 0.1) against one vote for the overall share of toxic
examples, so that far neighbours alone decide nothing; votes become probabilities by a monotone fit to the
leave-one-out votes of the examples. The fit uses a bounded sample of labelled rows; scores cover all texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.llm.common import words_of

#: Labelled rows that the fit takes at most (a random choice by hash of the key, the same at every run).
SAMPLE_ROWS = 12_000
#: Lengths of word beginnings that are terms, in bytes; toxic examples that have a term at least, and the least ratio of
#: its (smoothed) shares of toxic and other examples.
STEMS, LEAST_TOXIC, LEAST_RATIO = (4, 5, 6, 7), 2, 4.0
#: Neighbours that vote, examples of a block, and blocks that a search opens first.
NEIGHBOURS, BLOCK, FIRST_BLOCKS = 15, 64, 8
#: Score from which a text is predicted toxic.
CUTOFF = 0.7


def terms_of(words: list[bytes]) -> set[bytes]:
    """Terms of a text: words, and beginnings of words that are longer than these (marked with a blank)."""
    out = set(words)
    out.update([w[:k] + b" " for w in out for k in STEMS if len(w) > k])
    return out


@dataclass
class Examples:
    """The fitted index: vocabulary with inverse document frequencies, postings (examples and weights) by term, block
    maxima, the examples' keys and labels, and the calibration steps."""

    vocabulary: dict[bytes, int]
    idf: np.ndarray
    labels: np.ndarray
    keys: list
    listed: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    maxima: np.ndarray = None
    steps: tuple[np.ndarray, np.ndarray] = None
    without: float = 0.0
    heads: frozenset[bytes] = frozenset()

    def __post_init__(self) -> None:
        self.heads = frozenset(t[: STEMS[0]] for t in self.vocabulary)

    def found(self, words: list[bytes]) -> Counter:
        """Frequencies of the terms of the vector space in a text."""
        own, heads, least = self.vocabulary, self.heads, STEMS[0]
        out: Counter = Counter()
        for w in words:
            if w[:least] in heads:
                for t in (w, *[w[:k] + b" " for k in STEMS if len(w) > k]):
                    if t in own:
                        out[t] += 1
        return out

    def vector(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Terms of the vector space in a text, and their weights; both empty for a text without any."""
        found = {self.vocabulary[t]: n for t, n in self.found(words).items()}
        at = np.fromiter(sorted(found), dtype=np.int64, count=len(found))
        weights = np.array([1 + math.log(found[i]) for i in at.tolist()]) * self.idf[at]
        return at, weights / (np.sqrt((weights**2).sum()) or 1.0)

    @property
    def postings(self) -> list[dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Per term, the postings of each block."""
        blocks = lambda ids: np.unique(ids // BLOCK).tolist()
        return [{b: (ids[ids // BLOCK == b] - b * BLOCK, weights[ids // BLOCK == b]) for b in blocks(ids)} for ids, weights in self.listed]

    def index(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        terms = np.concatenate([at for at, _ in vectors] or [np.zeros(0, dtype=np.int64)])
        weights = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        ids = np.repeat(np.arange(len(vectors)), [len(at) for at, _ in vectors])
        self.maxima = np.zeros((len(self.vocabulary), -(-len(vectors) // BLOCK)))
        np.maximum.at(self.maxima, (terms, ids // BLOCK), weights)
        order = np.argsort(terms, kind="stable")
        ends = np.cumsum(np.bincount(terms, minlength=len(self.vocabulary)))[:-1]
        self.listed = list(zip(np.split(ids[order], ends), np.split(weights[order], ends))) if self.vocabulary else []

    def nearest(self, at: np.ndarray, weights: np.ndarray, leave: int = -1) -> list[tuple[float, int]]:
        """The NEIGHBOURS examples of largest cosine above zero, ties by position; `leave` is left out."""
        if not len(at):
            return []
        bounds = weights @ self.maxima[at]
        best: list[tuple[float, int]] = []
        order, k, step = np.argsort(-bounds, kind="stable"), 0, FIRST_BLOCKS
        while k < len(order):
            bound = bounds[order[k]]
            if bound <= 0 or (len(best) == NEIGHBOURS and bound < -best[-1][0] - 1e-12):
                break
            opened = np.zeros(len(bounds), dtype=bool)
            opened[order[k : k + step]] = True
            cosines = np.zeros(len(bounds) * BLOCK)
            for t, w in zip(at.tolist(), weights.tolist()):
                rows, values = self.listed[t]
                own = opened[rows // BLOCK]
                cosines[rows[own]] += w * values[own]
            if leave >= 0:
                cosines[leave] = 0
            near = np.flatnonzero(cosines > 0)
            near = near[np.argsort(-cosines[near], kind="stable")[:NEIGHBOURS]]
            best = sorted([*best, *zip((-cosines[near]).tolist(), near.tolist())])[:NEIGHBOURS]
            k, step = k + step, 4 * step
        return [(-c, e) for c, e in best]

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of toxic among the neighbours, weighted by distance."""
        weights = [c / (1.1 - min(1.0, c)) for c, _ in found]
        return (self.labels.mean() + sum(w * self.labels[e] for w, (_, e) in zip(weights, found))) / (1 + sum(weights))

    def score(self, words: list[bytes]) -> tuple[float, list[tuple[float, int]]]:
        found = self.nearest(*self.vector(words))
        if not found:
            return self.without, []
        at, value = self.steps
        return float(np.interp(self.vote(found), at, value)), found


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing probabilities of label 1 for ascending votes, by pooling adjacent violators; each pool is
    pulled a little towards one half."""
    pools: list[list[float]] = []
    for v in np.unique(votes):
        own = labels[votes == v]
        pools.append([float(v), float(v), float(own.sum()), float(len(own))])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, hi, ones, n = pools.pop()
            pools[-1][1] = hi
            pools[-1][2] += ones
            pools[-1][3] += n
    at = np.array([x for lo, hi, _, _ in pools for x in (lo, hi + 1e-9)])
    value = np.array([(ones + 0.5) / (n + 1) for _, _, ones, n in pools for _ in range(2)])
    return at, np.maximum.accumulate(value)


def fit(rows: list[tuple]) -> Examples:
    """Fit to (key, text, label) rows; of equal texts the first counts. Without rows every score is 0; without
    differing terms it is the share of toxic rows."""
    rows = list({text: (key, text, label) for key, text, label in reversed(rows)}.values())[::-1]
    words = lambda: (words_of(text) for _, text, _ in rows)  # noqa: E731  one text's words at a time
    labels = np.array([label for _, _, label in rows], dtype=np.int64)
    counts = np.array([(labels == 0).sum(), (labels == 1).sum()])
    with_toxic: Counter = Counter()
    for w, y in zip(words(), labels.tolist()):
        if y:
            with_toxic.update(terms_of(w))
    likely = Examples({t: 0 for t, n in with_toxic.items() if n >= LEAST_TOXIC}, None, labels, [])
    with_other: Counter = Counter()
    for w, y in zip(words(), labels.tolist()):
        if not y:
            with_other.update(likely.found(w))
    chosen = []
    if counts.min() > 0:
        for t in sorted(likely.vocabulary):
            n0, n1 = with_other[t], with_toxic[t]
            ratio = (n1 + 0.5) / (counts[1] + 1) / ((n0 + 0.5) / (counts[0] + 1))
            if n0 + n1 < len(rows) and ratio >= LEAST_RATIO:
                chosen.append((t, n0 + n1))
    idf = np.array([math.log((1 + len(rows)) / (1 + n)) + 1 for _, n in chosen])
    model = Examples({t: i for i, (t, _) in enumerate(chosen)}, idf, labels, [key for key, _, _ in rows])
    vectors = [model.vector(w) for w in words()]
    model.index(vectors)
    votes, voted = [], []
    for e, v in enumerate(vectors):
        found = model.nearest(*v, leave=e)
        if found:
            votes.append(model.vote(found))
            voted.append(labels[e])
    model.steps = monotone(np.array(votes), np.array(voted)) if votes else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    bare = np.array([not len(at) for at, _ in vectors], dtype=bool)
    model.without = float((labels[bare].sum() + 0.5) / (bare.sum() + 1)) if len(rows) else 0.0
    return model


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, key: str, text: str, label: str, rows: int) -> list[tuple]:
    """At most `rows` labelled documents (key, text, label) for which `allowed` holds, chosen by hash of the key.

    Rows with a null key or label do not count; a key labelled both ways counts as toxic; of documents with one
    key the smallest text counts.
    """
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & allowed).groupBy(key)
        .agg((F.max(label) > 0).cast("int").alias("label")).orderBy(F.xxhash64(key), key).limit(rows)
    )
    found = docs.select(key, text).join(F.broadcast(chosen), key).groupBy(key, "label").agg(F.min(text).alias("text"))  # at most `rows` rows
    return sorted(((r[key], r["text"], r["label"]) for r in found.collect()), key=lambda r: str(r[0]))


def scored(docs: DataFrame, model: Examples, text: str = "text") -> DataFrame:
    """Add toxicity: struct of score (0 to 1), predicted (1 from CUTOFF on) and evidence, the neighbours as
    (key, cosine, label). A null or empty text and one without any term of the index has no evidence and the score
    of such examples."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE_ROWS
    out = T.StructType.fromDDL("score double, predicted int, evidence array<struct<key:string,cosine:double,label:int>>")

    @F.arrow_udf(out)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            rows = []
            for t in texts:
                score, found = m.score(words_of(t.as_py()))
                evidence = [{"key": str(m.keys[e]), "cosine": c, "label": int(m.labels[e])} for c, e in found]
                rows.append({"score": score, "predicted": int(score >= CUTOFF), "evidence": evidence})
            kind = pa.struct([("score", pa.float64()), ("predicted", pa.int32()), ("evidence", pa.list_(pa.struct([("key", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())])))])
            yield pa.array(rows, type=kind)

    return docs.withColumn("toxicity", run.asNondeterministic()(F.col(text)))
