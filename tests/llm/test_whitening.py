"""Whitening: exact sums, components against a plain decomposition, odd input."""

from fractions import Fraction

import numpy as np
import pytest

from areaflow.llm import whitening

NAN, INF = float("nan"), float("inf")


def plain(rows):
    """n, sums, eigenvalues and eigenvectors by a two-pass covariance of the distinct vectors."""
    x = np.unique(np.floor(256 * np.array(rows, dtype=float)).astype(np.int64), axis=0)
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), x.sum(axis=0), values[::-1], vectors[:, ::-1]


def test_equals_plain_decomposition(frame, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 7)
    draw = np.random.default_rng(3)
    rows = (draw.normal(size=(200, 6)) * [9, 5, 3, 1, 0.5, 0.1] + 2).astype(np.float32).tolist()
    rows += rows[:1] * 100  # a third of the table is one vector
    df = frame("vec_id long, embedding array<float>, n string", *[(i, r, "given") for i, r in enumerate(rows)])
    found = whitening.components(whitening.whitened(df.repartition(5))).toPandas()
    n, sums, values, vectors = plain(rows)
    assert set(found["n"]) == {n} and len(found) == 4 * len(rows)
    x = np.floor(256 * np.array(rows, dtype=float))
    expected = (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    got = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((expected * got).sum(axis=0))
    assert np.abs(got - expected * sign).max() < 1e-9
    deviation = found[found.component == 1].set_index("vec_id")["deviation"].sort_index()
    assert deviation.tolist() == [int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums))) for r in x.tolist()]
    assert np.allclose(found.groupby("component")["explained"].first(), values[:4] / values.sum(), rtol=1e-12)
    assert found["identity_error"].max() < 1e-10


def test_sums_are_exact_for_large_entries(frame):
    draw = np.random.default_rng(5)
    rows = [[int(a) for a in r] for r in draw.integers(-(1 << 61), 1 << 61, size=(40, 3))]
    fit_list = frame("x array<long>", *[(r,) for r in rows]).repartition(3)
    n, sums = whitening.dimension_sums(fit_list, 3)
    assert n == 40 and sums == [sum(r[d] for r in rows) for d in range(3)]
    centre = whitening.Whitening(n, sums, np.zeros(0), np.zeros((3, 0)), 0.0)
    found = whitening.pair_sums(fit_list, centre, 3)
    y = [[n * r[d] - sums[d] for d in range(3)] for r in rows]
    for i in range(3):
        for j in range(i, 3):
            assert found[i, j] == sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in y)
    model = whitening.fit(fit_list, 3)
    exact = [[Fraction(sum(r[i] * r[j] for r in y), n**3) for j in range(3)] for i in range(3)]
    back = model.vectors @ np.diag(model.values) @ model.vectors.T
    assert np.allclose(back / float(exact[0][0]), np.array([[float(c / exact[0][0]) for c in r] for r in exact]), rtol=1e-9)


@pytest.mark.parametrize("number", [0, 1, -1, (1 << 300) + 5, -(1 << 299) - 77, (1 << 32) - 1, -(1 << 32)])
def test_limbs(number):
    assert sum(v << (32 * k) for k, v in enumerate(whitening.limbs(number))) == number


def test_odd_rows(frame):
    kind = "vec_id long, embedding array<double>, label int"
    good = [[0.0, 1.0], [1.0, 0.0], [-0.001, 3.0], [1.0, 0.0]]
    bad = [None, [1.0, None], [NAN, 1.0], [INF, 1.0], [1e300, 1.0], [1.0], [], [1.0, 2.0, 3.0]]
    df = frame(kind, *[(i, v, 1) for i, v in enumerate(good + bad)], (None, good[0], 1))
    found = whitening.whitened(df).toPandas()
    assert sorted(found["vec_id"].fillna(-1)) == [-1, 0, 1, 2, 3] and set(found["n"]) == {3}
    assert all(len(w) == 2 for w in found["whitened"]) and found["identity_error"].max() < 1e-9
    assert whitening.components(whitening.whitened(df)).count() == 10


def test_without_variance_or_rows(frame):
    one = whitening.whitened(frame("vec_id long, embedding array<float>", *[(i, [0.5, 0.25]) for i in range(5)])).toPandas()
    assert one["whitened"].map(list).tolist() == [[None, None]] * 5 and set(one["deviation"]) == {0}
    assert one["identity_error"].isna().all() and one["explained"].map(list).tolist() == [[None, None]] * 5
    assert whitening.components(whitening.whitened(frame("vec_id long, embedding array<float>"))).count() == 0
    assert whitening.whitened(frame("vec_id long, embedding array<float>", (1, None), (2, []))).toPandas()["whitened"].map(len).tolist() == [0]


def test_flat_dimension_and_clashing_names(frame):
    rows = [(i, [float(i), 7.0, -float(i)], "a", "b", "c") for i in range(9)]
    df = frame("vec_id long, embedding array<double>, x string, w string, deviation string", *rows)
    found = whitening.whitened(df).toPandas()
    assert set(found["x"]) == {"a"} and set(found["w"]) == {"b"} and found["deviation"].dtype == "int64"
    assert all(w[0] is not None and np.isnan(np.array(list(w[1:]), dtype=float)).all() for w in found["whitened"])
    assert found["identity_error"].max() < 1e-12
    assert found["explained"].map(lambda e: abs(e[0] - 1) < 1e-12).all()
