"""Whitening of vectors, the covariance found exactly by polarisation.

Entries become whole numbers x. The fit list holds each distinct vector once: n vectors with the sum S of each
dimension, so that y = n * x - S is a centred whole number. Tasks add up y_i ** 2 for every dimension and
(y_i + y_j) ** 2 for every pair of dimensions, exactly. By the polarisation identity
2 y_i y_j = (y_i + y_j) ** 2 - y_i ** 2 - y_j ** 2, differences of these sums give every covariance; only the last
division, by n ** 3, rounds. The matrix (dimensions squared, whatever the number of rows) is all the driver gets; its
eigenvectors, scaled by the roots of the eigenvalues, whiten the rows in tasks.

Sums leave a task as LIMBS whole numbers of 32 bits each, which Spark adds up as longs without rounding or overflow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.llm.common import saved

#: Whole units in an entry of 1; components given.
SCALE, TOP = 256, 4
#: Rows that a task multiplies at a time, bits of the lower half of a number that is squared in halves, and limbs of a sum.
ROWS, HALF, LIMBS = 1_024, 26, 10


@dataclass
class Whitening:
    """Centre and components, from the fit list: the number of vectors, the sum of each dimension, eigenvalues (falling)
    with unit eigenvectors as columns, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def rank(self, top: int) -> int:
        """How many of the first `top` components have a variance that is not rounding alone."""
        least = len(self.values) * np.finfo(float).eps * max(self.values[0], 0) if len(self.values) else 0
        return int((self.values[:top] > least).sum())

    def centred(self, x: np.ndarray) -> np.ndarray:
        """y = n * x - S: whole numbers of 64 bits where they fit well, else of any size."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if largest >= 1 << (2 * HALF - 2) or int(x.min(initial=0)) == -(1 << 63):
            return self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return self.n * x - np.array(self.sums, dtype=np.int64)

    def project(self, x: np.ndarray, top: int) -> np.ndarray:
        """The first components of x, of variance one over the fit list."""
        k = self.rank(top)
        return (self.centred(x) / self.n).astype(np.float64) @ self.vectors[:, :k] / np.sqrt(self.values[:k])


def whole(vector: Column) -> Column:
    """x of every entry; null for a vector that is null or holds an entry that is null, not finite or too large."""
    units = F.transform(vector, lambda c: F.lit(float(SCALE)) * c.cast("double"))
    fits = F.forall(units, lambda c: F.coalesce(F.abs(c) < F.lit(2.0**63), F.lit(False)) & ~F.isnan(c))
    return F.when(fits, F.transform(units, lambda c: F.floor(c)))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def limbs(number: int) -> list[int]:
    """A whole number in digits of 32 bits, the last one with the sign."""
    return [(number >> (32 * k)) & 0xFFFFFFFF for k in range(LIMBS - 1)] + [number >> (32 * (LIMBS - 1))]


def summed(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Sums of the rows (i, j, l0, l1, ...) as tasks give them, by (i, j)."""
    found = rows.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]).collect()
    return {(r["i"], r["j"]): sum(r[f"l{k}"] << (32 * k) for k in range(LIMBS)) for r in found}


SUMS = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))


def sum_rows(sums: dict[tuple[int, int], int]) -> pa.RecordBatch:
    columns = zip(*[(i, j, *limbs(v)) for (i, j), v in sums.items()])
    kinds = [pa.int32(), pa.int32()] + [pa.int64()] * LIMBS
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["i", "j", *[f"l{k}" for k in range(LIMBS)]])


def dimension_sums(fit_list: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(size, dtype=object)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                x = matrix(batch.column(0).slice(lo, ROWS), size)
                count += len(x)
                high = x >> 32  # halves, whose sums over ROWS rows fit
                total += high.sum(axis=0).astype(object) * (1 << 32) + (x - (high << 32)).sum(axis=0).astype(object)
        if count:
            yield sum_rows({(-1, -1): count} | {(d, d): int(v) for d, v in enumerate(total)})

    found = summed(fit_list.select("x").mapInArrow(run, SUMS))
    return found.get((-1, -1), 0), [found.get((d, d), 0) for d in range(size)]


def square_sums(y: np.ndarray) -> np.ndarray:
    """Exact column sums of squares, as numbers of any size."""
    if len(y) > ROWS:
        return sum(square_sums(y[lo : lo + ROWS]) for lo in range(0, len(y), ROWS))
    if y.dtype == object:
        return (y * y).sum(axis=0)
    high = y >> HALF
    low = y - (high << HALF)
    parts = ((high * high).sum(axis=0), (high * low).sum(axis=0), (low * low).sum(axis=0))
    a, b, c = (p.astype(object) for p in parts)
    return a * (1 << 2 * HALF) + b * (1 << HALF + 1) + c


def pair_sums(fit_list: DataFrame, centre: Whitening, size: int) -> dict[tuple[int, int], int]:
    """Sums of y_i ** 2, as (i, i), and of (y_i + y_j) ** 2, as (i, j), over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(size - i, dtype=object) for i in range(size)]
        seen = False
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                y = centre.centred(matrix(batch.column(0).slice(lo, ROWS), size))
                seen = True
                for i in range(size):
                    z = y[:, i:].copy()
                    z[:, 1:] += y[:, i : i + 1]
                    sums[i] += square_sums(z)
        if seen:
            for i in range(size):
                yield sum_rows({(i, i + k): int(v) for k, v in enumerate(sums[i])})

    return summed(fit_list.select("x").mapInArrow(run, SUMS))


def common_size(rows: DataFrame) -> int:
    """The commonest number of entries, the larger of equally common ones; 0 without rows."""
    first = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def fit(fit_list: DataFrame, size: int) -> Whitening:
    """Components of distinct vectors x of one size. Eigenvectors have their largest entry above zero."""
    n, sums = dimension_sums(fit_list, size)
    if not n or not size:
        return Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    centre = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    found = pair_sums(fit_list, centre, size)
    own = [found[i, i] for i in range(size)]
    covariance = np.empty((size, size))
    for (i, j), v in found.items():
        covariance[i, j] = covariance[j, i] = (own[i] if i == j else (v - own[i] - own[j]) // 2) / n**3
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(size)])
    return Whitening(n, sums, values, vectors * sign, sum(own) / n**3)


def identity_error(fit_list: DataFrame, model: Whitening, size: int, top: int) -> float | None:
    """The largest entry, without sign, of the covariance of the whitened fit list minus the identity; None where no
    component has a variance. Rows are whitened around their mean, so products are of centred values."""
    k = model.rank(top)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = model.project(matrix(batch.column(0), size), top)
            total += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    found = fit_list.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    return max(abs(r["v"] / model.n - (r["i"] == r["j"])) for r in found)


def whitened(vectors: DataFrame, vector: str = "embedding", top: int = TOP) -> DataFrame:
    """Rows with n (vectors of the fit list), deviation (sum over dimensions of y ** 2), whitened and explained (arrays
    over the first `top` components) and identity_error.

    Rows are left out whose vector is null, holds a null entry, one that is not finite or one beyond 2 ** 63 / 256 in
    size, or has another number of entries than most (of equally common numbers the larger one counts). Vectors have min(top, dimensions) components; one without
    variance, as all of a fit list of one vector, is null in whitened, and explained is null where the trace is 0. A
    deviation beyond a long is null. Repeated rows, and rows with a null key, each give a row; equal eigenvalues leave
    their components in the order that the decomposition gives them, the same for all rows. An empty table gives no
    rows. Columns of the names given replace input columns.
    """
    rows = vectors.select(F.struct("*").alias("given"), whole(F.col(vector)).alias("x")).filter("x is not null")
    size = common_size(rows)
    rows = rows.filter(F.size("x") == size)
    fit_list = saved(rows.select("x").distinct(), "whitening-list")
    model = fit(fit_list, size)
    error = identity_error(fit_list, model, size, top)
    k, given = model.rank(top), min(top, size)
    explained = [float(max(v, 0) / model.trace) if model.trace else None for v in model.values[:given]]
    kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    @F.arrow_udf(T.StructType.fromDDL("deviation long, whitened array<double>"))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = []
            for lo in range(0, len(column), ROWS):
                x = matrix(column.slice(lo, ROWS), size)
                deviation = square_sums(model.centred(x).T)
                w = model.project(x, top).tolist()
                out += [{"deviation": int(d) if d < 1 << 63 else None, "whitened": r + [None] * (given - k)} for d, r in zip(deviation, w)]
            yield pa.array(out, type=kind)

    found = rows.withColumn("w", run(F.col("x")))
    out = {
        "n": F.lit(model.n).cast("long"), "deviation": F.col("w.deviation"), "whitened": F.col("w.whitened"),
        "explained": F.array(*[F.lit(v) for v in explained]).cast("array<double>"), "identity_error": F.lit(error).cast("double"),
    }
    kept = [F.col("given")[c].alias(c) for c in vectors.columns if c not in out]
    return found.select(*kept, *[c.alias(name) for name, c in out.items()])


def components(rows: DataFrame) -> DataFrame:
    """One row for each component of the rows of whitened(), numbered from 1."""
    named = [c for c in rows.columns if c not in ("whitened", "explained", "component")]
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("_position", "_component")
    found = rows.select(*named, each)
    return found.select(*named, (F.col("_position") + 1).alias("component"), "_component.whitened", "_component.explained")
