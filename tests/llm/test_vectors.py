"""Near copies of vectors: counts, components and kept rows as all pairs give them."""

import numpy as np
import pytest

from areaflow.llm import vectors


def cases(seed, n=400, d=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n // 4):
        v = rng.normal(size=d)
        for _ in range(rng.integers(1, 8)):
            rows.append((v + rng.normal(size=d) * rng.choice([0.0, 0.02, 0.05, 0.2])).astype(np.float32))
    return [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(rows)]


def all_pairs(rows, cosine=0.98):
    n = len(rows)
    v = np.array([r[1] for r in rows], dtype=float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    near = (v @ v.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(n)
    while True:
        new = np.minimum(root, np.where(near, root[None, :], n).min(axis=1))
        if (new == root).all():
            return near.sum(axis=1), root
        root = new


@pytest.mark.parametrize(("cells", "block"), [(64, 1024), (3, 10)])
def test_equals_all_pairs(frame, monkeypatch, cells, block):
    monkeypatch.setattr(vectors, "CELLS", cells)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rows = cases(1)
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(30)]
    n, root = all_pairs(rows)
    assert n.max() > 5
    docs = frame("vec_id long, embedding array<float>, label int, n_links string", *[(*r, "own") for r in rows]).repartition(4)
    got = {r["vec_id"]: r for r in vectors.near_copies(docs).collect()}
    assert [got[i]["n_links"] for i in range(len(rows))] == n.tolist()
    assert [got[i]["component_id"] for i in range(len(rows))] == root.tolist()
    assert all(got[i]["kept"] == (i == root[i]) for i in range(len(rows)))


def test_what_cannot_link(frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [0.0, 0.0], 1),
        (8, [nan, 1.0], 1), (9, [inf, 0.0], 1), (10, [None, 1.0], 1), (11, [1.0], 1), (12, [], 1), (None, [1.0, 0.0], 2), (13, [1e-30, 0.0], 1),
    ]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_copies(frame("vec_id long, embedding array<float>, label int", *rows)).collect()}
    assert got == {**{r[0]: (0, r[0]) for r in rows}, 1: (2, 1), 2: (2, 1), 13: (2, 1)}


def test_empty_and_useless_tables(frame):
    docs = frame("vec_id long, embedding array<float>, label int", (1, None, 1))
    assert vectors.near_copies(docs.limit(0)).count() == 0
    assert [tuple(r) for r in vectors.near_copies(docs).collect()] == [(1, 0, 1, True)]
