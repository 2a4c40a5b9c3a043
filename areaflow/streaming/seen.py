"""Keys that a stream has seen, as keyed state, and the store of its new rows.

State is kept for each snapshot hour (dealt into buckets, so that a hot hour is the work of many tasks): the digests of
the keys seen there. A row whose digest is there is a re-delivery. A timer for each hour lets go of the digests once
the stream's clock, the latest snapshot time so far, is KEEP beyond the hour; only a mark stays. Rows that come even
later are not lost and not doubled: they leave the operator as rows to be checked, and only their own hours of the store
are read to do so. So state holds the hours that still receive rows, however long the history is, and a re-delivery
is recognised whatever its age.

The store is partitioned by date, hour and batch. A batch that runs again after a failure writes the same partitions
again, so every row is stored exactly once.

Where the stored rows of the hours with new rows are read at the end of a run anyway (run_hours), no state is kept: batches
are set down as they come, and one grouping of all rows of the run and the keys stored in their hours finds the new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

KEYS = ("entity_id", "stop_sequence", "snapshot_timestamp")
TIME = "snapshot_timestamp"
HOUR = ("snapshot_date", "snapshot_hour")
BATCH = "stored_batch"
#: How long after its hour the keys of an hour stay in state, and into how many groups an hour is dealt.
KEEP, BUCKETS = 72 * 3_600_000, 4
DIGEST = 16
#: Tasks of the state for each core, at most.
TASKS_A_CORE = 2
#: Rows of an hour that one task groups, where no state is kept; and the hour of rows without a time.
HOUR_ROWS, NO_HOUR = 1 << 18, -(1 << 62)
#: Columns that travel with the rows.
SHARE = {"hour": "_seen_hour", "bucket": "_seen_bucket", "digest": "_seen_digest", "order": "_seen_order", "whole": "_seen_whole"}


class SeenKeys(StatefulProcessor):
    """Hands on the rows of an hour whose key is new, one for each key; with a flag that is false where the keys of the
    hour were let go before, so that the store has to be asked."""

    def __init__(self, columns: list[str], keep: int) -> None:
        self.columns, self.keep = columns, keep

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "digests binary, whole boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        digests, whole = self.seen.get() if self.seen.exists() else (b"", True)
        digests = bytes(digests)
        old = {digests[k : k + DIGEST] for k in range(0, len(digests), DIGEST)}
        new: dict[bytes, Row] = {}
        for row in rows:
            digest = bytes(row[SHARE["digest"]])
            if digest not in old and (digest not in new or row[SHARE["order"]] < new[digest][SHARE["order"]]):
                new[digest] = row
        if new:
            self.seen.update((digests + b"".join(new), whole))
        hour = key[0]
        if hour is not None and not list(self.handle.listTimers()):
            self.handle.registerTimer(hour * 3_600_000 + 3_600_000 + self.keep)
        kind = Row(*self.columns, SHARE["whole"])
        for row in new.values():
            yield kind(*[row[c] for c in self.columns], whole)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.seen.update((b"", False))
        yield from ()

    def close(self) -> None:
        pass


def new_rows(stream: DataFrame, keys: tuple[str, ...] = KEYS, order: str | None = None, keep: int = KEEP, buckets: int = BUCKETS) -> DataFrame:
    """Rows of a stream whose key is new, with the flag of SeenKeys.

    Where rows of one key differ within a batch, the one with the largest `order` is taken (null last), then the
    first by the digest of the whole row. Rows without a time are an hour of their own, whose keys are never let go.
    """
    marked = stream.withColumns(
        {
            SHARE["hour"]: _hour(),
            SHARE["digest"]: F.unhex(_digest(stream, keys)),
            SHARE["order"]: F.concat(_turned(stream, order), _digest(stream, stream.columns)),
        }
    ).withColumn(SHARE["bucket"], F.pmod(F.xxhash64(SHARE["digest"]), F.lit(buckets)).cast("int"))
    # the clock is a copy of the time: rows behind it are late, but they are rows all the same
    clocked = marked.withColumn("_seen_clock", F.col(TIME)).withWatermark("_seen_clock", "0 seconds").drop("_seen_clock")
    kind = T.StructType([*stream.schema.fields, T.StructField(SHARE["whole"], T.BooleanType())])
    return clocked.groupBy(SHARE["hour"], SHARE["bucket"]).transformWithState(SeenKeys(stream.columns, keep), kind, "append", "eventTime")


def _hour() -> Column:
    return F.floor(F.unix_seconds(F.col(TIME)) / 3600).cast("long")


def _digest(stream: DataFrame, columns: tuple[str, ...] | list[str]) -> Column:
    """Digest of columns; times with all their digits, which JSON would cut."""
    times = (T.TimestampType, T.TimestampNTZType)
    exact = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) if isinstance(stream.schema[c].dataType, times) else F.col(c) for c in columns]
    return F.md5(F.to_json(F.struct(*exact), {"ignoreNullFields": "false"}))


def _turned(stream: DataFrame, order: str | None) -> Column:
    """Text that sorts the larger values of a time or number first, and null last."""
    if order is None:
        return F.lit("")
    field = stream.schema[order].dataType
    if isinstance(field, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(F.col(order).cast("timestamp"))
    elif isinstance(field, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value = F.col(order).cast("long")
    else:
        raise ValueError(f"{order} is neither a time nor a whole number")
    turned = F.lit((1 << 63) - 1).cast("decimal(20,0)") - value.cast("decimal(20,0)")
    return F.coalesce(F.concat(F.lit("0"), F.lpad(turned.cast("string"), 20, "0")), F.lit("1"))


def with_hour(rows: DataFrame) -> DataFrame:
    """Add the date and hour by which rows are stored."""
    return rows.withColumns({"snapshot_date": F.to_date(F.col(TIME)), "snapshot_hour": F.hour(F.col(TIME))})


def stored_schema(columns: T.StructType) -> T.StructType:
    hour = [T.StructField("snapshot_date", T.DateType()), T.StructField("snapshot_hour", T.IntegerType())]
    return T.StructType([*[f for f in columns.fields if f.name not in (*HOUR, BATCH)], *hour, T.StructField(BATCH, T.LongType())])


def stored_rows(spark: SparkSession, store: str, columns: T.StructType) -> DataFrame:
    """Rows stored so far, with their date, hour and batch; none before the first batch."""
    schema = stored_schema(columns)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(store)
    return spark.read.schema(schema).parquet(store)


def in_hours(rows: DataFrame, hours: list[Row]) -> DataFrame:
    """Stored rows of the given hours, by literal conditions on the partition columns: other hours are not even listed
    for the scan. Hours of a calendar are few, however many rows they hold."""
    by_date: dict[Any, list[int]] = {}
    for date, hour in hours:
        by_date.setdefault(date, []).append(hour)
    date, hour = (F.col(c) for c in HOUR)
    one = [date.isNull() if d is None else (date == F.lit(d)) & hour.isin(*h) for d, h in by_date.items()]
    return rows.where(reduce(lambda a, b: a | b, one, F.lit(False)))


def store_batch(rows: DataFrame, number: int, store: str, keys: tuple[str, ...] = KEYS) -> list[Row]:
    """Store the rows of new_rows() of one batch, those to be checked only if the store does not hold their key; returns
    the hours that got rows."""
    spark, columns = rows.sparkSession, rows.drop(SHARE["whole"]).schema
    dated = with_hour(rows).persist()
    try:
        checked = dated.where(~F.col(SHARE["whole"]))
        asked = checked.select(*HOUR).distinct().collect()
        fresh = dated
        if asked:
            earlier = in_hours(stored_rows(spark, store, columns), asked).where(F.col(BATCH) != number)
            old = earlier.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
            fresh = dated.where(SHARE["whole"]).unionByName(checked.join(old, same, "left_anti"))
        else:
            stored_rows(spark, store, columns)
        writer = fresh.drop(SHARE["whole"]).withColumn(BATCH, F.lit(number).cast("long")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*HOUR, BATCH).parquet(store)
        return fresh.select(*HOUR).distinct().collect()
    finally:
        dated.unpersist()


def run_new_rows(
    stream: DataFrame, store: str, checkpoint: str, after: Callable[[DataFrame, list[Row]], None] | None = None,
    keys: tuple[str, ...] = KEYS, order: str | None = None, keep: int = KEEP, buckets: int = BUCKETS,
) -> None:
    """Store every row of what is there now once, then hand the stored rows of the hours that got new ones to `after`.

    `after` is called once for all batches of a run, so that an hour is read once however many batches bring rows of it.
    The last batch that it has seen is kept beside the checkpoint: hours of batches that a failed run left behind are in
    the next call.

    Store and checkpoint belong together: a new checkpoint for a store that has rows is an error, since its keys would
    not be known.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    _belong(spark, store, checkpoint)

    def handle(rows: DataFrame, number: int) -> None:
        store_batch(rows, number, store, keys)

    found = new_rows(stream, keys, order, keep, buckets)
    writer = found.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # each task of the state starts Python and opens a store in every batch, so a new checkpoint gets as many as the
    # cores can use; an old one keeps its number
    shuffles = "spark.sql.shuffle.partitions"
    before = spark.conf.get(shuffles)
    spark.conf.set(shuffles, min(int(before), TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    try:
        query = writer.start()  # takes the settings of this moment
    finally:
        spark.conf.set(shuffles, before)
    query.awaitTermination()
    if after:
        rows = stored_rows(spark, store, stream.schema)
        hours = rows.where(F.col(BATCH) > _handed_on(spark, checkpoint)).select(*HOUR, BATCH).distinct().collect()  # as many as folders
        if hours:
            after(in_hours(rows, list({(h[0], h[1]) for h in hours})), sorted({Row(**{c: h[c] for c in HOUR}) for h in hours}, key=str))
            _hand_on(spark, checkpoint, max(h[BATCH] for h in hours))


def fresh_rows(
    arrived: DataFrame, stored: DataFrame, keys: tuple[str, ...] = KEYS, order: str | None = None, buckets: dict[int, int] | None = None
) -> DataFrame:
    """Rows that arrived (with their batch) under keys that are not stored for their hour, one for each key and hour: the
    first batch's, and within it the one that new_rows() takes. Without state: one grouping of both tables, dealt out by hour, so
    that a task writes whole hours; large hours are dealt into `buckets`."""
    columns = [c for c in arrived.columns if c != BATCH]
    others = [c for c in columns if c not in keys]
    one = (SHARE["hour"], SHARE["bucket"], *keys)
    rows = arrived.withColumn(SHARE["order"], F.concat(_turned(arrived, order), _digest(arrived, columns))) if others else arrived
    both = rows.unionByName(stored.select(*{*keys, TIME}).withColumn(BATCH, F.lit(-1).cast("long")), allowMissingColumns=True)
    parts = F.create_map(*[F.lit(v).cast("long") for pair in (buckets or {NO_HOUR: 1}).items() for v in pair])
    dealt = both.withColumn(SHARE["hour"], F.coalesce(_hour(), F.lit(NO_HOUR).cast("long"))).withColumn(
        SHARE["bucket"], F.pmod(F.xxhash64(*keys), F.coalesce(F.try_element_at(parts, F.col(SHARE["hour"])), F.lit(1).cast("long")))
    )
    groups = dealt.repartition(SHARE["hour"], SHARE["bucket"]).groupBy(*one)
    if not others:
        return groups.agg(F.min(BATCH).alias(BATCH)).where(F.col(BATCH) >= 0).select(*columns)
    first = groups.agg(F.min(BATCH).alias(BATCH), F.min_by(F.struct(*others), F.struct(BATCH, SHARE["order"])).alias("_others"))
    return first.where(F.col(BATCH) >= 0).select(*keys, "_others.*").select(*columns)


def run_hours(
    stream: DataFrame, store: str, checkpoint: str, after: Callable[[DataFrame, list[Row]], None], keys: tuple[str, ...] = KEYS, order: str | None = None
) -> None:
    """As run_new_rows() with `after`, for callers that read the hours with new rows in every run.

    Batches are only set down, beside the checkpoint and each in a folder of its own, which it writes again after a failure. When the
    backlog is worked off, the new rows of all batches are stored at once under the number of the last one, hours that got some are
    handed on, and what was set down is removed. A run that fails before that leaves its batches to the next. So the
    work of a run does not grow with its number of batches, and no hour is read that got no rows.
    """
    spark, down = stream.sparkSession, f"{checkpoint}/arrived"
    _belong(spark, store, checkpoint)

    def handle(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{down}/{BATCH}={number}")

    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if not _exists(spark, down):
        return
    kind, last = T.StructType([*stream.schema.fields, T.StructField(BATCH, T.LongType())]), _handed_on(spark, checkpoint)
    arrived = spark.read.schema(kind).parquet(down).where(F.col(BATCH) > last)
    hour = F.coalesce(_hour(), F.lit(NO_HOUR).cast("long")).alias(SHARE["hour"])
    found = with_hour(arrived).groupBy(*HOUR, hour).agg(F.max(BATCH).alias(BATCH), F.count(F.lit(1)).alias("rows")).collect()
    if not found:
        return
    newest, rows = max(h[BATCH] for h in found), stored_rows(spark, store, stream.schema)
    earlier = in_hours(rows, list({(h[0], h[1]) for h in found})).where(F.col(BATCH) != newest)
    large = {h[SHARE["hour"]]: -(-h["rows"] // HOUR_ROWS) for h in found if h["rows"] > HOUR_ROWS}
    fresh = with_hour(fresh_rows(arrived, earlier, keys, order, large)).withColumn(BATCH, F.lit(newest).cast("long"))
    writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*HOUR, BATCH).parquet(store)
    rows = stored_rows(spark, store, stream.schema)
    hours = rows.where(F.col(BATCH) > last).select(*HOUR).distinct().collect()  # also those of a run that failed
    if hours:
        after(in_hours(rows, hours), sorted(hours, key=str))
    _hand_on(spark, checkpoint, newest)
    place = spark._jvm.org.apache.hadoop.fs.Path(down)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _belong(spark: SparkSession, store: str, checkpoint: str) -> None:
    if not _exists(spark, f"{checkpoint}/offsets") and _exists(spark, f"{store}/_SUCCESS"):
        raise ValueError(f"{store} holds rows, but {checkpoint} is new")


def _handed_on(spark: SparkSession, checkpoint: str) -> int:
    """The last batch whose hours were handed on."""
    done = f"{checkpoint}/handed_on"
    return spark.read.parquet(done).first()[0] if _exists(spark, f"{done}/_SUCCESS") else -1


def _hand_on(spark: SparkSession, checkpoint: str, batch: int) -> None:
    spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/handed_on")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
