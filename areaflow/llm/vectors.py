"""Near copies of vectors by product quantisation, exact at a cosine of 0.98 or more.

Vectors are scaled to length one, so a cosine bound is a distance bound r. A coarse quantiser deals them out to
inverted lists (one per label and cell); a list keeps each vector's residual to the cell's centre as a code per
subspace, and the length of what the code loses. A vector probes every cell whose region comes within r of it: by the
distance to the plane between that cell and its own, no link can be missed. In a list, table lookups give the
distance from the probing vector to each code; a pair stays if that distance is at most r and what the code loses
(triangle inequality), and the exact cosine in double precision decides. Equal vectors are handled once. Lists are
dealt out in blocks of bounded size, against blocks of their probes, so a hot label or cell is the work of many
tasks; tasks return counts and a spanning star of links, not pairs.

Centres and codebooks are fitted to a bounded sample; every row is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.llm.common import components, join_sets, part_of, saved, whole_groups

#: Vectors that the fit takes (about; at most twice as many), cells, subspaces and codes of each subspace.
SAMPLE_ROWS, CELLS, SUBSPACES, CODES = 8_192, 64, 8, 64
#: Rows of a list that meet probes in one task at a time.
BLOCK_ROWS = 1_024
#: Slack of comparisons of rounded distances; the exact cosine decides.
SLACK = 1e-6


def means(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's method from random rows."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(rows, centres)
        for c in range(len(centres)):
            own = rows[near == c]
            if len(own):
                centres[c] = own.mean(axis=0)
    return centres


def square_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1), 0)


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return square_distances(rows, centres).argmin(axis=1)


@dataclass
class Quantiser:
    """Cell centres, and for each subspace (a slice of the dimensions) the codebook of residuals."""

    centres: np.ndarray
    slices: list[slice]
    books: list[np.ndarray]

    def codes(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and the lengths of what they lose."""
        codes = np.stack([nearest(rest[:, s], b) for s, b in zip(self.slices, self.books)], axis=1)
        back = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(axis=1))

    def tables(self, rest: np.ndarray) -> np.ndarray:
        """Squared distances of residuals to every code of every subspace."""
        out = np.full((len(rest), len(self.books), CODES), np.inf)
        for m, (s, b) in enumerate(zip(self.slices, self.books)):
            out[:, m, : len(b)] = square_distances(rest[:, s], b)
        return out


def fit(rows: np.ndarray, seed: int = 7) -> Quantiser:
    centres = means(rows, CELLS, seed)
    rest = rows - centres[nearest(rows, centres)]
    edges = np.linspace(0, rows.shape[1], min(SUBSPACES, rows.shape[1]) + 1).astype(int)
    slices = [slice(a, b) for a, b in zip(edges, edges[1:])]
    return Quantiser(centres, slices, [means(rest[:, s], CODES, seed) for s in slices])


def usable(vector: str, size: int) -> F.Column:
    """Whether a vector can link: of the size of the others, finite in every component, and not zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == size) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(column: pa.ChunkedArray, size: int) -> np.ndarray:
    rows = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)
    rows = rows / np.abs(rows).max(axis=1)[:, None]  # no overflow in the length
    return rows / np.sqrt((rows**2).sum(axis=1))[:, None]


def links(nodes: DataFrame, size: int, cosine: float) -> DataFrame:
    """From distinct vectors (id, label, vector, copies): rows (id, other, n). The n of an id add up to the copies of the
    vectors linked to it, and the pairs (id, other) connect exactly what links connect."""
    sample = part_of(nodes.select("id", "vector"), F.col("id"), SAMPLE_ROWS).toArrow().sort_by("id")
    if not sample.num_rows:
        return nodes.select("id", F.col("id").alias("other"), F.lit(0).cast("long").alias("n")).limit(0)
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    shared = nodes.sparkSession.sparkContext.broadcast(fit(unit(sample.column("vector"), size)))  # bounded by its parameters

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to its own cell's list (probe 0), and as a probe to every cell within reach, its own too."""
        q = shared.value
        apart = np.sqrt(square_distances(q.centres, q.centres))
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                rows = unit(pa.chunked_array([part.column(2)]), size)
                d = square_distances(rows, q.centres)
                own = d.argmin(axis=1)
                least = d[np.arange(len(d)), own]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d - least[:, None]) / (2 * apart[own])  # distance to the plane before each cell
                reach = (plane <= radius + SLACK) | (d <= least[:, None])
                i, c = np.nonzero(reach)
                row, cell = np.concatenate((np.arange(len(own)), i)), np.concatenate((own, c))
                probe = np.repeat([0, 1], [len(own), len(i)])
                for k in range(0, len(row), 4096):
                    at = pa.array(row[k : k + 4096])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1).take(at), pa.array(cell[k : k + 4096].astype(np.int32)), pa.array(probe[k : k + 4096].astype(np.int32)),
                         part.column(0).take(at), part.column(3).take(at), part.column(2).take(at)],
                        names=["label", "cell", "probe", "id", "copies", "vector"],
                    )

    kind = nodes.schema
    dealt = saved(nodes.select("id", "label", "vector", "copies").mapInArrow(deal, T.StructType([kind["label"], *T.StructType.fromDDL("cell int, probe int"), kind["id"], kind["copies"], kind["vector"]])), "vectors-lists")
    # blocks of each list and of its probes meet in every combination, each in a group of its own
    blocks = dealt.groupBy("label", "cell").agg(*[F.greatest(F.lit(1), F.ceil(F.sum((F.col("probe") == p).cast("int")) / BLOCK_ROWS)).cast("int").alias(f"n{p}") for p in (0, 1)])
    rows = dealt.join(blocks, ["label", "cell"])
    mine = F.when(F.col("probe") == 0, F.pmod(F.xxhash64("id"), "n0")).otherwise(F.pmod(F.xxhash64("id"), "n1"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), (F.when(F.col("probe") == 0, F.col("n1")) .otherwise(F.col("n0")) - 1).cast("long")))
    rows = rows.select("*", mine.alias("mine"), others.alias("theirs"))
    first, second = F.when(F.col("probe") == 0, F.col("mine")).otherwise(F.col("theirs")), F.when(F.col("probe") == 0, F.col("theirs")).otherwise(F.col("mine"))
    rows = rows.select("label", "cell", first.alias("a"), second.alias("b"), "probe", "id", "copies", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for t, starts in whole_groups(batches, ["label", "cell", "a", "b"], 1 << 14):
            probes, ids, copies = t.column("probe").to_numpy(), t.column("id").to_numpy(), t.column("copies").to_numpy()
            root = np.arange(len(t))
            cells, vectors = t.column("cell").to_numpy(), unit(t.column("vector"), size)
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
                cut = lo + int((probes[lo:hi] == 0).sum())
                if cut in (lo, hi):
                    continue
                rest = vectors[lo:hi] - q.centres[cells[lo]]
                codes, lost = q.codes(rest[: cut - lo])
                for p in range(cut, hi, 256):
                    tables = q.tables(rest[p - lo : min(p + 256, hi) - lo])
                    distance = np.sqrt(sum(tables[:, m, :][:, codes[:, m]] for m in range(codes.shape[1])))
                    i, j = np.nonzero(distance <= radius + lost + SLACK)
                    i, j = i + p, j + lo
                    other = ids[i] != ids[j]
                    i, j = i[other], j[other]
                    near = np.zeros(len(i), dtype=bool)
                    for k in range(0, len(i), 1 << 16):
                        part = slice(k, k + (1 << 16))
                        near[part] = (vectors[i[part]] * vectors[j[part]]).sum(axis=1) >= cosine
                    i, j = i[near], j[near]
                    join_sets(root, i, j)
                    at, where = np.unique(i, return_inverse=True)
                    n = np.bincount(where, weights=copies[j], minlength=len(at)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[at]), pa.array(n)], names=["id", "other", "n"])
            child = np.flatnonzero(root != np.arange(len(t)))
            pair = [pa.array(ids[child]), pa.array(ids[root[child]])]
            yield pa.RecordBatch.from_arrays([*pair, pa.array(np.zeros(len(child), dtype=np.int64))], names=["id", "other", "n"])

    group = ["label", "cell", "a", "b"]
    return rows.repartition(*group).sortWithinPartitions(*group, "probe", "id").mapInArrow(run, "id long, other long, n long")


def near_copies(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row per vector: key, n_links (other vectors linked directly), component_id (smallest key reachable by
    links, itself included) and kept (key = component_id).

    Vectors link within a label at the cosine or above. Null labels, and vectors that are null, zero, of another
    size than most or hold null or non-finite components, link with nothing and are components of their own. Equal
    vectors of one label link with each other. Keys are whole numbers; a repeated key is a vector of its own. An
    empty table gives no rows.
    """
    base = vectors.select(F.col(key).alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), F.monotonically_increasing_id().alias("row"))
    sizes = base.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("size")).count()
    size = sizes.orderBy(F.desc("count"), "size").first()
    size = size["size"] if size else 1
    base = saved(base.withColumn("good", usable("vector", size) & F.col("label").isNotNull()), "vectors-rows")
    nodes = saved(
        base.filter("good").groupBy("label", "vector").agg(F.min("row").alias("id"), F.min("key").alias("least"), F.count(F.lit(1)).alias("copies")),
        "vectors-nodes",
    )
    found = saved(links(nodes, size, cosine), "vectors-links")
    roots = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")), "vectors").withColumnRenamed("v", "id")
    counted = found.groupBy("id").agg(F.sum("n").alias("n"))
    full = nodes.join(roots, "id", "left").join(counted, "id", "left").withColumn("root", F.coalesce("root", "id"))
    owner = full.groupBy("root").agg(F.min("least").alias("component_id"))
    full = full.join(owner, "root").select("label", "vector", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    good = base.filter("good").join(full, ["label", "vector"]).select("key", "n_links", "component_id")
    bad = base.filter(~F.col("good")).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return good.unionAll(bad).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
