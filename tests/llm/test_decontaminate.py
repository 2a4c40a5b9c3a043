"""Benchmark decontamination: hits, items and longest matches as plain search gives them."""

import random
import re
from pathlib import Path

import numpy as np
import pytest

from areaflow.llm import decontaminate as dc


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, window=10):
    """(key, n_words, n_hit, items) of each document, trying every window at every word."""
    out = []
    for key, text in docs:
        d, hit, names = words(text), set(), set()
        for name, item in items:
            w = words(item)
            size = min(window, len(w))
            for p in range(len(w) - size + 1 if w else 0):
                for q in range(len(d) - size + 1):
                    if d[q : q + size] == w[p : p + size]:
                        hit.update(range(q, q + size))
                        names.add(str(name)) if name is not None else None
        out.append((key, len(d), len(hit), sorted(names)))
    return sorted(out, key=str)


def case(seed, docs=60, items=25):
    draw = random.Random(seed)
    vocabulary = ["a", "b", "c", "d", "été", "X1", "中文"]
    def make(n):
        return [draw.choice(vocabulary) for _ in range(n)]

    tests = [(k, make(draw.choice([3, 9, 10, 11, 25]))) for k in range(items)]
    texts = []
    for k in range(docs):
        body = make(draw.randint(0, 80))
        for _ in range(draw.randint(0, 2)):
            _, t = draw.choice(tests)
            cut = draw.randint(0, max(0, len(t) - 10))
            at = draw.randint(0, len(body))
            body[at:at] = t[cut : cut + draw.choice([9, 10, 30])]
        texts.append((k, draw.choice([" ", ", ", "\n"]).join(body)))
    return texts + texts[:5], [(k, " ".join(t).upper()) for k, t in tests]


def found(docs, items, **more):
    rows = dc.contamination(docs, items, **more).collect()
    assert all(r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"]) for r in rows)
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows], key=str)


@pytest.mark.parametrize(("shard", "block", "listed"), [(1 << 19, 8 << 20, 1 << 21), (150, 200, 7), (1, 1, 1)])
def test_equals_plain_search(frame, monkeypatch, shard, block, listed):
    monkeypatch.setattr(dc, "SHARD_WORDS", shard)
    monkeypatch.setattr(dc, "LISTED", listed)
    monkeypatch.setattr(dc, "BLOCK_BYTES", max(block, 200))
    docs, items = case(shard)
    expected = plain(docs, items)
    assert sum(r[2] > 0 for r in expected) > 20 and sum(r[2] == 0 for r in expected) > 5
    assert found(frame("doc_id long, text string", *docs).repartition(4), frame("item_id long, text string", *items)) == expected


def test_longest_matches(frame, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_WORDS", 200)
    docs, items = case(8)
    rows = dc.longest_matches(frame("doc_id long, text string", *docs).repartition(3), frame("item_id long, text string", *items)).collect()
    expected = set()
    for name, item in items:
        w, best = words(item), set()
        for size in range(len(w), 0, -1):
            for key, text in docs:
                d = words(text)
                best |= {(str(name), size, p, key, q) for p in range(len(w) - size + 1) for q in range(len(d) - size + 1) if w[p : p + size] == d[q : q + size]}
            if best:
                break
        expected |= best
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


@pytest.mark.parametrize("kind", ["random", "equal", "copies"])
@pytest.mark.parametrize("depth", [1, 2, 7, 40])
def test_suffix_array(kind, depth):
    draw = np.random.default_rng(depth)
    ids = {"random": draw.integers(0, 4, 300), "equal": np.zeros(300, dtype=int), "copies": np.tile(draw.integers(0, 1 << 20, 30), 10)}[kind]
    order = dc.suffix_array(ids.astype(np.int32), depth)
    assert sorted(order.tolist()) == list(range(300))
    heads = [tuple(ids[p : p + depth].tolist()) for p in order]
    assert heads == sorted(heads)


def test_odd_rows(frame):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (3, "!?"), (None, f"x {item} y"), (4, item * 1 + " " + "w " * 700_000 + item), (4, "clean words"), (5, "A short\u00a0thing"), (6, "one two three four five six seven eight nine"), (6, "ten eleven")]
    items = [(1, item), (1, item), (7, None), (8, " "), (None, "clean words"), ("b", "SHORT\u00a0thing")]
    kind = "doc_id long, text string, shard string, items int, spans int"
    df, tests = frame(kind, *[(*d, "s", 1, 2) for d in docs]), frame("item_id string, text string, key int", *[(None if i is None else str(i), t, 0) for i, t in items])
    rows = found(df, tests)
    assert rows == sorted([(1, 0, 0, []), (2, 0, 0, []), (3, 0, 0, []), (None, 13, 11, ["1"]), (4, 700_022, 22, ["1"]), (4, 2, 2, []), (5, 2, 1, ["b"]), (6, 9, 0, []), (6, 2, 0, [])], key=str)
    left = dc.without_leaks(df, dc.contamination(df, tests))
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 6, 6]


def test_empty_tables(frame):
    docs, items = frame("doc_id long, text string", (1, "a b")), frame("item_id long, text string", (1, "a"))
    assert found(docs, items.limit(0)) == [(1, 2, 0, [])] and found(docs.limit(0), items) == []
    assert dc.longest_matches(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_shards_are_not_stored(spark, frame, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    scratch = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))

    def stored():
        return {f: f.stat().st_size for f in scratch.rglob("*.parquet")}

    draw, before = random.Random(5), stored()
    docs = [(k, " ".join(draw.choice(["a", "b", "c", "d"]) for _ in range(20_000))) for k in range(4)]
    items = [(k, " ".join(draw.choice(["x", "y", "z"]) for _ in range(40))) for k in range(8)]
    rows = dc.contamination(frame("doc_id long, text string", *docs, (9, items[3][1])), frame("item_id long, text string", *items))
    assert [(r["doc_id"], r["items"]) for r in rows.filter("n_hit > 0").collect()] == [(9, ["3"])]
    assert sum(size for f, size in stored().items() if f not in before) < sum(len(text) for _, text in docs) / 4
