"""Hidden Markov model: likelihoods and expected counts by enumeration, scores by definition."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from areaflow.llm import hmm
from areaflow.llm.common import words_of


def small(states=3, classes=5, seed=0):
    rng = np.random.default_rng(seed)
    unit = lambda x: x / x.sum(axis=-1, keepdims=True)
    return hmm.Model(unit(rng.random(states)), unit(rng.random((states, states))), unit(rng.random((states, classes))))


def by_paths(m, ids):
    """Likelihood and expected counts from all state paths."""
    k = len(m.start)
    start, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros_like(m.emit), 0.0
    for path in itertools.product(range(k), repeat=len(ids)):
        p = m.start[path[0]] * math.prod(m.move[a, b] for a, b in zip(path, path[1:])) * math.prod(m.emit[s, x] for s, x in zip(path, ids))
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
        for s, x in zip(path, ids):
            emits[s, x] += p
    return total, start / total, moves / total, emits / total


def test_forward_and_expected_counts_equal_enumeration():
    m = small()
    sequences = [np.array(x) for x in ([0], [1, 2], [4, 4, 3, 0, 1, 2], [2, 2, 2], [3])]
    laid = hmm.Sequences(sequences)
    paths = [by_paths(m, s.tolist()) for s in sequences]
    assert laid.forward(m)[0] == pytest.approx([math.log10(p[0]) for p in paths])
    for got, at in zip(laid.expected(m), (1, 2, 3)):
        assert got == pytest.approx(sum(p[at] for p in paths))


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(1)
    sequences = [np.repeat(rng.integers(0, 5, 6), 4) for _ in range(40)]
    laid, m = hmm.Sequences(sequences), small(seed=2)
    before = laid.forward(m)[0].sum()
    for _ in range(5):
        start, moves, emits = laid.expected(m)
        m = hmm.Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=1, keepdims=True))
        after = laid.forward(m)[0].sum()
        assert after >= before - 1e-9
        before = after


def test_long_texts_neither_overflow_nor_stop():
    assert np.isfinite(hmm.Sequences([np.zeros(50_000, dtype=np.int64)]).forward(small())[0][0])


@pytest.mark.parametrize("dictionary", [4, 200_000])
def test_scores_of_a_table(frame, monkeypatch, dictionary):
    monkeypatch.setattr(hmm, "DICTIONARY", dictionary)
    texts = ["the cat sat on the mat", "The dog sat", "", None, "the the unknown\vword", "cat " * 300, "the cat sat on the mat"]
    rows = [(i, t, t is not None and i != 4, "own") for i, t in enumerate(texts)]
    docs = frame("doc_id long, text string, train boolean, score string", *rows)
    got = {r["doc_id"]: r for r in hmm.scored(docs, F.col("train")).collect()}
    counts = Counter()
    for _, t, train, _ in rows:
        if train:
            counts.update([*words_of(t), b""])
    total = sum(counts.values())
    for i, t in enumerate(texts):
        tokens = [*words_of(t), b""]
        assert got[i]["n_tokens"] == len(tokens) and got[i]["train_tokens"] == total
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens))
        assert got[i]["score"] < 0 and math.isfinite(got[i]["score"])
    assert got[0]["score"] == pytest.approx(got[6]["score"])


def test_shares_of_a_class_add_up():
    words = [f"w{i}".encode() for i in range(300)]
    c = np.arange(1, 301)
    cls = np.array([hmm.OWN_CLASSES + zlib.crc32(w[-3:]) % hmm.SHARED_CLASSES for w in words])
    tokens, distinct = np.zeros(hmm.SHARED_CLASSES, dtype=int), np.zeros(hmm.SHARED_CLASSES, dtype=int)
    np.add.at(tokens, cls - hmm.OWN_CLASSES, c)
    np.add.at(distinct, cls - hmm.OWN_CLASSES, 1)
    v = hmm.Vocabulary({}, c, cls, int(c.sum()), 300, tokens, distinct)
    k = cls[0]
    own = np.append(c[cls == k], 0)
    e = np.random.default_rng(5).random((len(own), 3)) * own[:, None]
    by_state = hmm.within_class(e, own, v.unknown()[np.full(len(own), k)], e.sum(axis=0))
    assert by_state.sum(axis=0) == pytest.approx(np.ones(3))


def test_empty_tables(frame):
    docs = frame("doc_id long, text string", (1, "a b"), (None, None))
    assert hmm.scored(docs.limit(0), F.lit(True)).count() == 0
    got = hmm.scored(docs, F.lit(False)).collect()
    assert [r["n_known"] for r in got] == [0, 0] and all(r["score"] < 0 or r["n_tokens"] == 1 for r in got)


def test_clashing_names(frame):
    names = ["row", "known", "rare", "classes", "base", "share", "_text", "_train", "_e", "chain", "score", "_in0"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    docs = frame(schema, *[(k, "some words here and words there" if k % 2 else None, *names) for k in range(8)])
    found = hmm.scored(docs, F.col("doc_id") < 6).toPandas()
    assert len(found) == 8 and all((found[n] == n).all() for n in names if n != "score")
    assert set(found["n_tokens"]) == {1, 7} and found["score"].dtype == float


def test_every_word_has_emissions_of_its_own(frame, monkeypatch):
    """Scores by a plain forward recursion over words, with the model's class parameters and the expected counts of
    every word summed anew from the posteriors. Frequent words fill the classes of one word, so that the others share."""
    rng = np.random.default_rng(9)
    kinds = [[f"{kind}{i}{'pqr' if i % 2 else 'stu'}" for i in range(200)] for kind in "ab"]
    texts = [" ".join(kinds[i % 2][rng.integers(200)] for _ in range(rng.integers(0, 20))) for i in range(80)] + ["a1pqr unknown b2stu"]
    texts.append(" ".join(f"f{i}" for i in range(hmm.OWN_CLASSES - 1)) * 12)
    docs = frame("doc_id long, text string", *enumerate(texts))
    trained, full_round, steps, made = hmm.trained, hmm.full_round, [], []

    def round_of(train, model, vocabs, by_word):
        steps.append(model)
        return full_round(train, model, vocabs, by_word)

    def model_of(train, vocab):
        made.append((trained(train, vocab), vocab))
        return made[-1][0]

    monkeypatch.setattr(hmm, "full_round", round_of)
    monkeypatch.setattr(hmm, "trained", model_of)
    tokens = {i: [*words_of(t), b""] for i, t in enumerate(texts)}
    train = [*range(60), 81]
    counts = Counter(w for i in train for w in tokens[i])
    for dictionary in (8_300, 200_000):
        monkeypatch.setattr(hmm, "DICTIONARY", dictionary)
        scores = {r["doc_id"]: r["score"] for r in hmm.scored(docs, F.col("doc_id").isin(train)).collect()}
        (model, *_), vocab = made[-1]
        own = {w: int(vocab.classes[k]) for w, k in vocab.places.items() if vocab.classes[k] < hmm.OWN_CLASSES}
        cls = {w: own.get(w, hmm.class_of(w)) for ws in tokens.values() for w in ws}
        shared = [w for w in counts if w not in own]
        assert len(shared) > 300 and all(w in vocab.places for w in shared) == (dictionary > 8_300)
        e = {w: np.zeros(hmm.STATES) for w in counts}
        for i in train:
            laid = hmm.Sequences([np.array([cls[w] for w in tokens[i]])])
            for w, g in zip(tokens[i], laid.posterior(steps[-1])[2][laid.where]):
                e[w] = e[w] + (g if w in vocab.places else np.rint(g * hmm.STEPS) / hmm.STEPS)
        whole, size = {cls[w]: 0 for w in cls}, Counter()
        for w in shared:
            whole[cls[w]] = whole[cls[w]] + e[w]
            size[cls[w]] += counts[w] + 1
        for i, ws in tokens.items():
            a, total = None, 0.0
            for w in ws:
                k, p = cls[w], np.ones(hmm.STATES)
                if w not in own:
                    p = p / (size[k] + 1)
                    if counts[w]:
                        p = (e[w] * size[k] + hmm.SHARE_WEIGHT * (counts[w] + 1)) / (whole[k] + hmm.SHARE_WEIGHT) / (size[k] + 1)
                a = (model.start if a is None else a @ model.move) * model.emit[:, k] * p
                total += math.log10(a.sum())
                a = a / a.sum()
            assert scores[i] == pytest.approx(total)


def test_start_counts_neighbours_of_all_training_texts(frame, monkeypatch):
    """More texts than the sample that used to choose the start: every one of them is counted."""
    texts = [f"w{i} the w{i % 7}" if i % 3 else "" for i in range(5_000)]
    docs = frame("doc_id long, text string", *enumerate(texts))
    neighbours, made = hmm.neighbours, []

    def found(train, vocabs):
        made.append((neighbours(train, vocabs), vocabs.value))
        return made[-1][0]

    vocabulary = hmm.vocabulary
    monkeypatch.setattr(hmm, "neighbours", found)
    monkeypatch.setattr(hmm, "vocabulary", lambda counts: made.append(vocabulary(counts)) or made[-1])
    hmm.scored(docs, F.col("doc_id") % 5 > 0)
    vocab, (pairs, classes) = made
    expected = np.zeros((hmm.GROUPS, hmm.GROUPS))
    for i, t in enumerate(texts):
        if i % 5:
            groups = hmm.group_of(classes[[vocab.places[w] for w in [*words_of(t), b""]]])
            np.add.at(expected, (groups[:-1], groups[1:]), 1)
    assert (pairs == expected).all() and pairs.sum() == 3 * sum(1 for i in range(5_000) if i % 3 and i % 5)


def test_packed_counts_come_back(frame):
    e = [[1, 1024, 0, 0, 0, 0, 0], [255, 255 * 1024, 0, 3, 4, 5, 255 * 1024], [256, 256 * 1024, 1, 0, 0, 9, 0], [0] * 7, [1 << 40, 0, 1 << 50, 0, 7, 0, 0], [3, 512, 512, 512, 512, 512, 512]]
    rows = frame("k int, e array<long>", *enumerate(e)).select("k", hmm.packed(F.col("e")).alias("v"))
    found = rows.select("v", F.array(*[hmm.part_in(F.col("v"), k) for k in range(7)]).alias("e")).orderBy("k").collect()
    assert [r["e"] for r in found] == e and [len(r["v"]) for r in found] == [2, 2, 7, 2, 7, 2]
    assert hmm.unpacked(np.array([x for r in found for x in r["v"]])).tolist() == e
