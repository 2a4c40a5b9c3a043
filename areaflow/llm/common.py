"""Helpers of the text operators: tables in the shared folder, words, groups in sorted partitions, components.

Conventions of all operators here: input columns other than those named by the operator are never read;
where an output column has the name of an input column, the output column replaces it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.runtime import scratch_path

#: The white space of the contracts, as a Java pattern, and the byte map that lower-cases A-Z only.
BLANKS = r"[\x20\x09-\x0D]+"
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps survive lost executors without the work
    behind it, and never run it twice."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """Words (runs without ASCII white space) of a text, as UTF-8 bytes with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()


def words(text: Column) -> Column:
    """Words of a text column as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def bucket_of(key: Column, parts: int) -> Column:
    """crc32 of a key's text, modulo parts; 0 for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts)), F.lit(0))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 19) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Blocks of about `rows` rows of a partition sorted by the keys, cut between groups only; with the row at
    which each group starts and, last, the number of rows."""
    held: list[pa.RecordBatch] = []
    count = 0

    def block(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(len(t), dtype=bool)
        new[:1] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return t, np.append(np.flatnonzero(new), len(t))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= rows:
            t, starts = block(held)
            if len(starts) > 2:
                cut = int(starts[-2])
                yield t.slice(0, cut), starts[:-1]
                held = t.slice(cut).to_batches()
                count = len(t) - cut
            else:
                held, rows = t.to_batches(), 2 * count
    if held:
        yield block(held)


def part_of(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About `rows` rows chosen by a hash of the key, the same at every run, and never more than twice as many; each
    task hands on its share only."""
    parts = max(1, math.ceil(df.count() / rows))
    return df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == 0).limit(2 * rows)


def join_sets(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of the row pairs i, j, in place: root holds the smallest row of each row's set."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of the edges (a, b): one row (v, root) for each vertex, root being the smallest
    vertex reachable from v.

    Each round hooks vertices and their parents to the smallest grandparent among the neighbours, and halves the
    way to the root, until nothing changes; the number of rounds grows with the logarithm of the longest path.
    Every round is a few joins and a grouped minimum, written to the shared folder. An empty input gives no rows.
    """
    e = saved(
        edges.filter("a <> b").select("a", "b").unionAll(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{label}-edges",
    )
    f = saved(e.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("f")), f"{label}-roots")
    total = F.sum(F.col("f").cast("decimal(38,0)"))
    before = f.agg(total).first()[0]
    while before is not None:
        grand = f.join(f.select(F.col("v").alias("f"), F.col("f").alias("g")), "f")
        offers = e.join(grand.select(F.col("v").alias("b"), F.col("g").alias("offer")), "b").groupBy("a").agg(F.min("offer").alias("offer"))
        best = grand.join(offers, F.col("v") == F.col("a")).select("v", "f", F.least("g", "offer").alias("best"))
        hooks = best.groupBy(F.col("f").alias("v")).agg(F.min("best").alias("best"))
        f = saved(
            best.select("v", "best").unionAll(hooks).groupBy("v").agg(F.min("best").alias("f")),
            f"{label}-roots",
        )
        after = f.agg(total).first()[0]
        if after == before:
            break
        before = after
    return f.select("v", F.col("f").alias("root"))
