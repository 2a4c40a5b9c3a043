"""SimHash: fingerprints by definition, the trie walk against all pairs, and which documents stay."""

import random

import numpy as np
import xxhash

from areaflow.llm import simhash
from areaflow.llm.common import components, words_of


def by_definition(text, n=3):
    w = words_of(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_definition():
    for text in (None, "", " \n", "One", "one TWO", "one two three", "ÄB äb ÄB c", "a b c d e f g " * 30):
        assert simhash.fingerprint(words_of(text), 3)[0] == by_definition(text)


def test_walk_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2)
    close = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 6), replace=False))) for b in base[:150]]
    v = np.unique(np.concatenate([base, np.array(close, dtype=np.uint64)]))
    walk = simhash.Trie([v], 3)
    ends = [np.array([0]), np.array([len(v)])]
    walk.join(*ends, *ends)
    root = np.arange(len(v))
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 3
    for _ in range(len(v)):
        new = np.where(near, root[None, :], len(v)).min(axis=1)
        if (new == root).all():
            break
        root = new
    assert (walk.root == root).all()


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words)


def corpus(rng):
    rows, groups = [], []
    for _ in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(400)]
        texts = [" ".join(words)] + [edited(rng, words, 0.002) for _ in range(rng.randrange(3))]
        groups.append(range(len(rows), len(rows) + len(texts)))
        rows += texts
    return rows, groups


def test_components_equal_all_pairs(frame):
    rng = random.Random(5)
    texts, _ = corpus(rng)
    texts += ["", None, " ", "", texts[0], texts[0]]
    rows = [(i, t) for i, t in enumerate(texts)]
    prints = [by_definition(t) for t in texts]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    got = simhash.near_copies(frame("doc_id long, text string", *rows).repartition(5)).collect()
    assert sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == [(i, p, r) for i, (p, r) in enumerate(zip(prints, root))]


def test_full_subtries_are_split_without_loss(frame, monkeypatch):
    monkeypatch.setattr(simhash, "SUBTRIE_ROWS", 4)
    test_components_equal_all_pairs(frame)


def test_one_of_each_group_stays(frame):
    """Documents stay that are the smallest of their component, links being at most three differing bits."""
    rng = random.Random(9)
    texts, groups = corpus(rng)
    texts += [texts[g[0]] for g in groups] + [texts[groups[0][0]].upper(), " ".join(texts[3].split())]
    prints = [by_definition(t) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in range(len(texts)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(texts))]
    docs = frame("doc_id long, text string, fp string, row int", *[(i, t, "own", 1) for i, t in enumerate(texts)])
    stay = simhash.drop_near_copies(docs.repartition(4))
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(set(root))
    assert len(set(root)) < len(texts) - len(groups)


def test_nulls_repeats_and_empty_tables(frame):
    schema = "doc_id long, text string"
    docs = frame(schema, (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, None), (9, ""))
    assert sorted(r["doc_id"] for r in simhash.drop_near_copies(docs).collect()) == [7, 8]
    empty = docs.limit(0)
    assert simhash.near_copies(empty).count() == simhash.drop_near_copies(empty).count() == 0


def test_components_of_long_paths(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["v"]: r["root"] for r in components(edges, "t").collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 100: 100, 101: 100}
