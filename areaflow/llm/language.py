"""Language of a text in two steps: its family first, then linear support vector machines between the family's languages.

Features are square roots of counts of letter pairs and triples, hashed, at length one. Families are found in the
training sample by joining the languages whose mean features are most alike. One machine per family separates it
from the rest; within a family one machine per pair of languages votes. The fit uses a bounded sample per language;
predictions read whole texts and nothing but the text.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Training texts of each language, and of all, at most (chosen by hash of the key).
LANGUAGE_ROWS, SAMPLE_ROWS = 400, 12_000
DIMENSIONS = 1 << 12
#: Code points of a text that are counted at a time.
CHUNK = 1 << 20
NONE = "und"


@functools.cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(text: str | None) -> np.ndarray | None:
    """Features of a text, or None where it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    counts = np.zeros(DIMENSIONS)
    found = False
    for lo in range(0, len(points), CHUNK):
        part = points[max(0, lo - 2) : lo + CHUNK]
        kept = np.where(letters()[part], part, 32).astype(np.uint32)
        found = found or bool((kept != 32).any())
        kept = np.concatenate(([32], kept, [32])).astype(np.uint32)
        kept = kept[(kept != 32) | np.concatenate(([True], kept[:-1] != 32))]  # one blank between words
        pairs = kept[:-1] * np.uint32(0x9E3779B1) + kept[1:] * np.uint32(0x85EBCA77)
        triples = (pairs[:-1] ^ (pairs[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE3D) + kept[2:] * np.uint32(0x27D4EB2F)
        for h in (pairs, triples):
            counts += np.bincount((h ^ (h >> np.uint32(13))) % DIMENSIONS, minlength=DIMENSIONS)
    if not found:
        return None
    root = np.sqrt(counts)
    return (root / np.sqrt(counts.sum())).astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge) for labels -1 and 1 of balanced weight, by
    accelerated gradient steps."""
    n = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w = np.zeros(x.shape[1])
    ahead, step, t = w, 1 / (1 + 4 * c), 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (ahead - 2 * c * (x.T @ (n * y * slack)))
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def chance(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, 4 * margin))))


@dataclass
class Languages:
    """Families of languages, a machine for each family, and one for each pair of languages of a family."""

    families: list[list[str]]
    of_family: list[tuple[np.ndarray, float]]
    of_pair: dict[tuple[str, str], tuple[np.ndarray, float]]

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.families:
            return NONE, 0.0
        family, score = 0, 1.0
        if len(self.families) > 1:
            margins = [float(x @ w) + b for w, b in self.of_family]
            family = int(np.argmax(margins))
            score = chance(margins[family])
        listed = self.families[family]
        won = dict.fromkeys(listed, 0.0)
        for a, b in combinations(listed, 2):
            w, bias = self.of_pair[a, b]
            p = chance(float(x @ w) + bias)
            won[a] += p
            won[b] += 1 - p
        best = max(listed, key=lambda k: (won[k], k))
        return best, score * (won[best] / (len(listed) - 1) if len(listed) > 1 else 1.0)


def families_of(centres: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages joined by greatest mean likeness until as many families are left as the root of their number."""
    groups = [[k] for k in sorted(centres)]
    unit = {k: v / np.linalg.norm(v) for k, v in centres.items()}
    while len(groups) > math.ceil(math.sqrt(len(centres))):
        likeness = lambda p: float(np.mean([unit[a] @ unit[b] for a in groups[p[0]] for b in groups[p[1]]]))  # noqa: E731, B023
        i, j = max(combinations(range(len(groups)), 2), key=likeness)
        groups[i] += groups.pop(j)
    return [sorted(g) for g in groups]


def fit(rows: list[tuple[str, str]]) -> Languages:
    """Fit to (text, language) rows; texts without letters do not count. Without rows every text is undetermined."""
    pairs = [(f, lang) for text, lang in rows if (f := features(text)) is not None]
    if not pairs:
        return Languages([], [], {})
    x, lang = np.stack([f for f, _ in pairs]), np.array([k for _, k in pairs])
    families = families_of({k: x[lang == k].mean(axis=0) for k in np.unique(lang).tolist()})
    of_family = []
    if len(families) > 1:
        of_family = [machine(x, np.where(np.isin(lang, g), 1.0, -1.0)) for g in families]
    of_pair = {}
    for g in families:
        for a, b in combinations(g, 2):
            own = (lang == a) | (lang == b)
            of_pair[a, b] = machine(x[own], np.where(lang[own] == a, 1.0, -1.0))
    return Languages(families, of_family, of_pair)


def sample(docs: DataFrame, allowed: Column, key: str, text: str, lang: str) -> list[tuple[str, str]]:
    """A bounded training sample of (text, language): of each language the first LANGUAGE_ROWS keys by hash."""
    first = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    known = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull() & allowed).select(key, lang)
    chosen = known.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= LANGUAGE_ROWS)
    chosen = chosen.orderBy("_n", lang).limit(SAMPLE_ROWS).select(key, lang).distinct()
    found = docs.select(key, lang, text).join(F.broadcast(chosen), [key, lang]).groupBy(key, lang).agg(F.min(text).alias("text"))  # at most SAMPLE_ROWS rows
    return [(r["text"], r["lang"]) for r in found.select(F.col(lang).alias("lang"), "text", key).orderBy("lang", key).collect()]


def identified(docs: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """Add language: struct of lang_pred (`und` where the text is null or has no letter) and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages times DIMENSIONS

    @F.arrow_udf(T.StructType.fromDDL("lang_pred string, score double"))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [shared.value.predict(t.as_py()) for t in texts]
            names, scores = [f[0] for f in found], [f[1] for f in found]
            yield pa.StructArray.from_arrays([pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())], ["lang_pred", "score"])

    return docs.withColumn("language", run.asNondeterministic()(F.col(text)))
