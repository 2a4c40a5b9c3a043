"""From the name of a dataset to its source files, and a record of every file that was read."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.runtime import lookup_join
from areaflow.sources.files import scan_all_string, snapshot_files
from areaflow.sources.quoted import CSV_FORM


@dataclass(frozen=True)
class Place:
    """Where a dataset lies: a folder, the name of its file (or folder of parts; empty: every file), and which count:
    the newest below the folder, all below it, or just the one in it."""

    folder: str
    file: str
    takes: str


# Folders and names of processed files (fixed values).
LAYOUT = {
    "stops": Place("gtfs_static", "stops.txt", "newest"),
    "routes": Place("gtfs_static", "routes.txt", "newest"),
    "trips": Place("gtfs_static", "trips.txt", "newest"),
    "stop_times": Place("gtfs_static", "stop_times.txt", "newest"),
    "trip_updates": Place("gtfs_realtime/feed=trip_updates", "parsed.csv", "all"),
    "service_alerts": Place("gtfs_realtime/feed=service_alerts", "parsed.csv", "all"),
    "stop_area_map": Place("geospatial", "stops_sa2_mapping.csv", "one"),
    "route_area_coverage": Place("geospatial", "route_sa2_coverage.csv", "one"),
    "observation_base": Place("analytics", "sa2_disruption_observations_base.csv", "one"),
    "area_index": Place("equity", "seifa_sa2_ready.csv", "one"),
}


def _plain(path: Column) -> Column:
    """A path as one text, whether its scheme is followed by one slash or more and its characters are escaped or not."""
    decoded = F.coalesce(F.try_url_decode(F.regexp_replace(path, r"\+", "%2B")), path)
    return F.regexp_replace(decoded, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _source(path: Column, place: Place, root: str) -> Column:
    """The path of the dataset's file (or folder of parts) that a listed file is, or belongs to; else null."""
    below = F.split(path, f"/{root.strip('/').split('/')[-1]}/{place.folder}/", 2)
    own, inner = F.get(below, F.lit(0)), F.get(below, F.lit(1))
    if not place.file:
        return F.when(inner.isNotNull(), path)
    end = rf"({'' if place.takes == 'one' else '(?:.*/)?'}{place.file.replace('.', '[.]')})(?:/.*)?"
    found = F.regexp_extract(inner, f"^{end}$", 1)
    return F.when(found != "", F.concat(own, F.lit(f"/{root.strip('/').split('/')[-1]}/{place.folder}/"), found))


def dataset_files(spark: SparkSession, root: str, layout: dict[str, Place] = LAYOUT) -> DataFrame:
    """The files of all datasets below root: dataset, source, path and size. Nothing is read but the listing; of
    datasets that take the newest file, the one of the greatest path counts, as dated folders sort by date."""
    listed = snapshot_files(spark, root).select(_plain(F.col("file_path")).alias("path"), F.col("length").alias("size"))
    each = F.filter(F.array(*[F.struct(F.lit(n).alias("dataset"), _source(F.col("path"), p, root).alias("source"), F.lit(p.takes).alias("takes")) for n, p in layout.items()]), lambda d: d["source"].isNotNull())
    found = listed.withColumn("d", F.explode(each)).select("path", "size", "d.*")
    newest = found.where("takes = 'newest'").groupBy("dataset").agg(F.max("source").alias("newest"))
    return lookup_join(found, newest, "dataset").where("newest is null or source = newest").select("dataset", "source", "path", "size")


def dataset_source(spark: SparkSession, root: str, name: str, layout: dict[str, Place] = LAYOUT) -> DataFrame | None:
    """All-string rows of a dataset from its files, aligned by one header, or None where it has none."""
    mine = dataset_files(spark, root, {name: layout[name]}).agg(F.max("source").alias("source"), F.count(F.lit(1)).alias("n")).first()
    if not mine["n"]:
        return None
    place = layout[name]
    if place.takes != "all":
        return scan_all_string(spark, mine["source"])
    reader = spark.read.options(**CSV_FORM, multiLine=True, recursiveFileLookup=True)
    rows = reader.csv(f"{root.rstrip('/')}/{place.folder}").na.fill("")
    return rows.where(F.col("_metadata.file_path").rlike(f"/{place.file.replace('.', '[.]')}(/|$)")) if place.file else rows


def dataset_sources(root: str, layout: dict[str, Place] = LAYOUT) -> dict:
    """The sources of all datasets, as plans.build.build takes them; each is looked up when it is built."""
    return {name: partial(dataset_source, root=root, name=name, layout=layout) for name in layout}


def source_files(spark: SparkSession, root: str, batch_id: str, layout: dict[str, Place] = LAYOUT) -> DataFrame:
    """One row per source file: id, dataset, path, size, rows, checksum and batch.

    Rows are counted per file in one pass with partial sums; files without rows count 0. The checksum is the sum of
    the rows' hashes, so it does not depend on their order, and repeated rows count.
    """
    listed = dataset_files(spark, root, layout)
    counted = []
    for name in layout:
        rows = dataset_source(spark, root, name, layout)
        if rows is not None:
            digest = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("checksum")
            by_file = rows.groupBy(_plain(F.col("_metadata.file_path")).alias("path")).agg(F.count(F.lit(1)).alias("row_count"), digest)
            counted.append(by_file.withColumn("dataset", F.lit(name)))
    none = spark.createDataFrame([], "path string, row_count bigint, checksum decimal(38,0), dataset string")
    counts = reduce(DataFrame.unionByName, counted, none)
    return lookup_join(listed, counts, ["dataset", "path"]).select(
        F.sha2(F.concat_ws("|", "dataset", "path", F.lit(batch_id)), 256).alias("source_file_id"),
        F.col("dataset").alias("dataset_name"),
        F.col("path").alias("source_path"),
        F.col("size").alias("file_size_bytes"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce(F.col("checksum").cast("string"), F.lit("0")).alias("checksum"),
        F.lit(batch_id).alias("load_batch_id"),
    )
