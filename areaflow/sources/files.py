"""Header text files, dated copies and snapshot directories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.functions.parsing import path_part, snapshot_time_of
from areaflow.sources.quoted import CSV_FORM, scan_quoted

SNAPSHOT_PARTS = ("feed", "year", "month", "day", "hour", "minute")



def scan_all_string(spark: SparkSession, *paths: str, free_text: bool = True, split: bool = False) -> DataFrame:
    """Read header text files as strings, aligned by column name. With split, many tasks share a large file although its
    fields may hold line breaks (see quoted.py); without, a file of free text is read by one task.

    Paths that share a header can be given as one glob; differing headers as separate paths. Empty
    fields become empty strings, while a column that a file lacks gives null. Files without line breaks in fields
    can be read with free_text=False, which lets several tasks share a file.
    """
    if free_text and split:
        return scan_quoted(spark, *paths)
    frames = [spark.read.options(**CSV_FORM, multiLine=free_text).csv(path).na.fill("") for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_source_label(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the path of the file each row was read from; only on a frame straight from a file scan."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def latest_load(
    spark: SparkSession, root: str, name: str | None = None, partition: str = "load_date", free_text: bool = True, split: bool = False
) -> DataFrame:
    """All-string rows of the newest load below root: of the file (or folder of parts) `name` in the newest load
    that holds it, or of all files of the newest load. The newest value comes from the file listing, so only these files are read."""
    paths = snapshot_files(spark, root)
    if name is not None:
        paths = paths.where(F.array_contains(F.split("file_path", "/"), name))
    newest = paths.agg(F.max(path_part(F.col("file_path"), partition, "[^/]+")).alias("newest")).first()["newest"]
    if newest is None:
        raise FileNotFoundError(f"No {partition}= directory with {name or 'files'} below {root}")
    path = f"{root}/{partition}={newest}" + (f"/{name}" if name else "")
    return scan_all_string(spark, path, free_text=free_text, split=split).withColumn(partition, F.lit(newest))


def scan_snapshots(spark: SparkSession, root: str, feed: str, columns: str) -> DataFrame:
    """Every parsed snapshot of one feed below root, with typed partition columns.

    The feed filter prunes directories. Headers must match the given columns (a DDL list).
    """
    full = f"{columns}, feed string, year int, month int, day int, hour int, minute int"
    files = spark.read.schema(full).option("basePath", root).options(**CSV_FORM, multiLine=True, enforceSchema=False)
    return files.csv(root).where(F.col("feed") == feed)


def partition_parts(df: DataFrame, path: str = "file_path") -> DataFrame:
    """Feed and snapshot time encoded in a path column; rows whose path has no such parts drop out."""
    where = F.col(path)
    return df.withColumns(
        {"feed": path_part(where, "feed", "[^/]+"), "snapshot_timestamp": snapshot_time_of(where)}
    ).where("feed is not null and snapshot_timestamp is not null")


def with_snapshot_parts(df: DataFrame) -> DataFrame:
    """Add year to minute as zero-padded text, as used in snapshot directory names."""
    text = F.split(F.date_format("snapshot_timestamp", "yyyy-MM-dd-HH-mm"), "-")  # formatted once
    return df.withColumns({part: text[k] for k, part in enumerate(SNAPSHOT_PARTS[1:])})


def snapshot_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per snapshot file below root, empty files included, without reading their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.col("path").alias("file_path"), "length")
