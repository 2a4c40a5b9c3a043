"""From source files to loaded tables, dataset by dataset, with quality rows and a manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.contracts import Contract, get_contract
from areaflow.operators.quality import check_dataset
from areaflow.operators.standardize import standardize
from areaflow.sources.sinks import dataset_path, write_partitioned

#: Gives the raw rows of a dataset, or None where it has no source.
Source = Callable[[SparkSession], DataFrame | None]

MANIFEST = (
    "load_batch_id string, dataset string, row_count bigint, source_count bigint, warnings bigint, errors bigint, "
    "message string"
)


def build_dataset(spark: SparkSession, contract: Contract, source: Source | None, root: str, batch_id: str) -> tuple:
    """Read, standardise, write and check one dataset; gives its manifest entry after the batch id.

    A missing source is an error, or a warning where the contract allows an empty dataset. A dataset that fails is an
    error with the reason, and leaves the other datasets alone.
    """
    missing = (contract.name, 0, 0, int(contract.allow_empty), int(not contract.allow_empty), "no source")
    try:
        raw = source(spark) if source else None
        if raw is None:
            return missing
        path = dataset_path(root, contract)
        write_partitioned(standardize(raw, contract, contract.name, batch_id), path)
        checks = check_dataset(spark.read.parquet(path), contract).withColumn("load_batch_id", F.lit(batch_id))
        reports = f"{root.rstrip('/')}/quality_reports/{batch_id}/{contract.name}"
        write_partitioned(checks, reports)
        row = spark.read.parquet(reports).agg(
            F.max(F.when(F.col("check") == "row_count", F.col("affected"))).alias("rows"),
            F.count_if(F.col("severity") == "warning").alias("warnings"),
            F.count_if(F.col("severity") == "error").alias("errors"),
        ).first()
        return contract.name, row["rows"], 1, row["warnings"], row["errors"], None
    except (PySparkException, FileNotFoundError) as e:
        return contract.name, 0, 1, 0, 1, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"


def build(spark: SparkSession, sources: dict[str, Source], names: tuple[str, ...], root: str, batch_id: str) -> DataFrame:
    """Build the named datasets below root and return the manifest: one row per dataset with the batch's total and
    status. Quality rows are kept per batch below root/quality_reports."""
    entries = [(batch_id, *build_dataset(spark, get_contract(n), sources.get(n), root, batch_id)) for n in names]
    manifest = spark.createDataFrame(entries, MANIFEST)
    total, errors = sum(e[2] for e in entries), sum(e[5] for e in entries)
    return manifest.withColumns(
        {"records_loaded": F.lit(total).cast("bigint"), "status": F.lit("completed_with_errors" if errors else "success")}
    )
