"""Toxicity: the block-max search against all examples, calibrated scores, and odd input."""

import random

import numpy as np
import pytest

from areaflow.llm import toxicity
from areaflow.llm.common import words_of

BAD = ("vermin", "scoundrel", "blockheaded", "nitwit", "oaf")


def texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 80))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(("", "ly", "ish")))
        yield i, " ".join(words), toxic


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(list(texts(1500, 1)))


def test_search_equals_all_examples(model):
    dense = np.zeros((len(model.labels), len(model.vocabulary)))
    for t, blocks in enumerate(model.postings):
        for b, (rows, weights) in blocks.items():
            dense[b * toxicity.BLOCK + rows, t] = weights
    for _, text, _ in texts(200, 2):
        at, weights = model.vector(words_of(text))
        cosines = dense[:, at] @ weights
        expected = sorted(cosines[cosines > 0], reverse=True)[: toxicity.NEIGHBOURS]
        assert [c for c, _ in model.nearest(at, weights)] == pytest.approx(expected)


def test_held_out_texts(model):
    held = list(texts(400, 3))
    scores = [model.score(words_of(t))[0] for _, t, _ in held]
    right = sum((s >= toxicity.CUTOFF) == bool(y) for s, (_, _, y) in zip(scores, held))
    assert right >= 0.98 * len(held) and all(0 <= s <= 1 for s in scores)


def test_votes_become_monotone():
    at, value = toxicity.monotone(np.array([0.1, 0.2, 0.3, 0.9]), np.array([1, 0, 0, 1]))
    assert list(value) == sorted(value) and np.interp(0.9, at, value) > np.interp(0.1, at, value)


def test_sample_and_scores_of_a_table(frame, model):
    docs = frame("doc_id long, text string, toxicity string", (1, None, "x"), (2, "", "x"), (3, "you vermin oaf nitwit", "x"), (None, "vermin vermin oaf", "x"), (3, "you vermin oaf nitwit", "x"))
    rows = toxicity.scored(docs, model).collect()
    assert [r["toxicity"]["predicted"] for r in sorted(rows, key=lambda r: str(r["text"]))] == [0, 0, 1, 1, 1]
    assert all(e["label"] in (0, 1) and 0 < e["cosine"] <= 1.000001 for r in rows for e in r["toxicity"]["evidence"])
    labels = frame("doc_id long, toxic int", (3, 1), (3, 0), (1, None), (None, 1), (2, 0), (99, 1))
    from pyspark.sql import functions as F

    assert toxicity.sample(docs, labels, F.lit(True), "doc_id", "text", "toxic", 10) == [(2, "", 0), (3, "you vermin oaf nitwit", 1)]
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_fit_without_rows_or_without_one_label():
    assert toxicity.fit([]).score([b"x"]) == (0.0, [])
    score, found = toxicity.fit([(1, "a", 0), (2, "b", 0)]).score([b"a"])
    assert score < 0.5 and not found


def test_terms_do_not_depend_on_the_number_of_examples():
    held = [r for r in texts(600, 4) if r[2]]
    for n in (150, 600, 3000):
        model = toxicity.fit(list(texts(n, 5)))
        assert all(w.encode() in model.vocabulary or w[:4].encode() + b" " in model.vocabulary for w in BAD)
        found = sum(model.score(words_of(t))[0] >= toxicity.CUTOFF for _, t, _ in held)
        assert found >= 0.9 * len(held)
