"""New snapshot files, hourly area measures and re-delivered rows as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from areaflow.operators.aggregate import area_hour_trips
from areaflow.plans.events import area_names, delays_at, stop_table
from areaflow.streaming.seen import BATCH, HOUR, KEEP, KEYS, run_hours, run_new_rows


def read_snapshots(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of snapshot files; each file is read once, also over restarts with the same checkpoint. With
    files_per_batch a backlog is worked off in several batches, which changes no result."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process every file that is there now into a parquet table, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_deduplicated(
    stream: DataFrame, store: str, checkpoint: str, keys: tuple[str, ...] = KEYS, order: str | None = None, keep: int = KEEP
) -> None:
    """Store every row once, re-delivered files or not, however long ago a row came first (see seen.new_rows)."""
    run_new_rows(stream, store, checkpoint, keys=keys, order=order, keep=keep)


def run_area_hours(
    stream: DataFrame, stop_map: DataFrame, store: str, target: str, checkpoint: str,
    keys: tuple[str, ...] = KEYS, order: str | None = None,
) -> None:
    """Keep delay measures per area and hour up to date, late rows and the last hours included.

    When the backlog is worked off, its new rows are stored, and the hours that got rows are computed anew from all
    their stored rows and replace their partitions of the target; no other hour is read. So measures equal those of a batch run, exact
    distinct counts too. Keys are compared with the stored ones of these hours, so no state is kept (see seen.run_hours).
    """

    def refresh(rows: DataFrame, _: list[Row]) -> None:
        stops = stop_table(stop_map)  # of known size and numbered, so that observations are not shuffled to join it
        measures = area_hour_trips(delays_at(rows.drop(*HOUR, BATCH), stops), area_names(stops))
        writer = measures.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*HOUR).parquet(target)

    run_hours(stream, store, checkpoint, refresh, keys, order)
