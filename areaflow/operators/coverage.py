"""Coverage of collected snapshots: what was polled, when, and whether it is enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions.rules import evidence_label, recommended_action, sufficiency

# Fixed values of the rules.
MORNING, EVENING = (7, 9), (16, 18)
EVIDENCE_DAYS, EVIDENCE_SNAPSHOTS_PER_DAY, EVIDENCE_PEAK_WEEKDAYS = 7, 4, 3
TRIP_FEED, ALERT_FEED = "trip_updates", "service_alerts"


def snapshot_rows(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Rows per feed and snapshot. With the list of snapshots given, those without rows stay with 0."""
    keys = ["feed", "snapshot_timestamp"]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    if files is not None:
        counted = files.select(*keys).distinct().join(counted, keys, "left")
    return counted.withColumn("row_count", F.coalesce("row_count", F.lit(0))).withColumn(
        "is_quiet", F.col("row_count") == 0
    )


def with_calendar(snapshots: DataFrame) -> DataFrame:
    """Date, hour and Monday-based weekday (0 to 6) of each snapshot."""
    time = F.col("snapshot_timestamp")
    return snapshots.withColumns(
        {"snapshot_date": F.to_date(time), "snapshot_hour": F.hour(time), "weekday": F.weekday(time)}
    )


def _at(hours: tuple[int, int]) -> Column:
    return F.col("snapshot_hour").between(*hours)


def coverage_summary(snapshots: DataFrame) -> DataFrame:
    """Snapshots, days, range, weekdays, peak snapshots, rows per feed, rating and recommended action."""
    weekday = F.col("weekday") < 5
    totals = with_calendar(snapshots).agg(
        F.count(F.lit(1)).alias("total_snapshots"),
        F.count_distinct("snapshot_date").alias("days_covered"),
        F.min("snapshot_date").alias("first_date"),
        F.max("snapshot_date").alias("last_date"),
        F.count_distinct(F.when(weekday, F.col("snapshot_date"))).alias("weekday_days_covered"),
        F.count_distinct(F.when(~weekday, F.col("snapshot_date"))).alias("weekend_days_covered"),
        F.count_if(_at(MORNING)).alias("morning_peak_snapshots"),
        F.count_if(_at(EVENING)).alias("evening_peak_snapshots"),
        *[
            F.coalesce(F.sum(F.when(F.col("feed") == feed, F.col("row_count"))), F.lit(0)).alias(name)
            for feed, name in ((TRIP_FEED, "trip_update_row_count"), (ALERT_FEED, "service_alert_row_count"))
        ],
    )
    return with_rating(totals, "days_covered")


def coverage_by(snapshots: DataFrame) -> DataFrame:
    """Snapshots per date, per feed and per hour in one pass, as rows (dimension, value, snapshots)."""
    facts = with_calendar(snapshots)
    values = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), F.col(column).cast("string").alias("value"))
            for name, column in (("date", "snapshot_date"), ("feed", "feed"), ("hour", "snapshot_hour"))
        ]
    )
    exploded = facts.select(F.explode(values).alias("v"))
    return exploded.groupBy("v.dimension", "v.value").agg(F.count(F.lit(1)).alias("snapshots"))


def with_rating(df: DataFrame, days: str) -> DataFrame:
    """Rating of the number of days, the action it calls for and the label results may carry."""
    rating = F.col("data_sufficiency_rating")
    return df.withColumn("data_sufficiency_rating", sufficiency(F.col(days))).withColumns(
        {"recommended_next_action": recommended_action(rating), "evidence_label": evidence_label(rating)}
    )


def sufficiency_rating(snapshots: DataFrame) -> DataFrame:
    days = with_calendar(snapshots).agg(F.count_distinct("snapshot_date").alias("days_covered"))
    return with_rating(days, "days_covered")


def evidence_ready(snapshots: DataFrame) -> DataFrame:
    """The four conditions for calling results evidence-ready, and whether all hold."""
    weekday = F.col("weekday") < 5
    days = (
        with_calendar(snapshots)
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("snapshots"),
            F.bool_or(F.col("feed") == TRIP_FEED).alias("has_trips"),
            F.bool_or(F.col("feed") == ALERT_FEED).alias("has_alerts"),
            (F.bool_or(weekday & _at(MORNING)) & F.bool_or(weekday & _at(EVENING))).alias("both_peaks"),
        )
    )
    totals = days.agg(
        F.count(F.lit(1)).alias("days_covered"),
        F.coalesce(F.avg("snapshots"), F.lit(0.0)).alias("snapshots_per_day"),
        F.coalesce(F.bool_or("has_trips") & F.bool_or("has_alerts"), F.lit(False)).alias("both_feeds"),
        F.count_if("both_peaks").alias("weekdays_with_both_peaks"),
    )
    ready = (
        (F.col("days_covered") >= EVIDENCE_DAYS)
        & (F.col("snapshots_per_day") >= EVIDENCE_SNAPSHOTS_PER_DAY)
        & F.col("both_feeds")
        & (F.col("weekdays_with_both_peaks") >= EVIDENCE_PEAK_WEEKDAYS)
    )
    return totals.withColumn("is_evidence_ready", ready)


def collection_summary(log: DataFrame) -> DataFrame:
    """Polling cycles attempted, successful (any feed ok) and failed, and rows collected.

    The log has one row per cycle and feed: cycle, ok, row_count.
    """
    cycles = log.groupBy("cycle").agg(
        F.bool_or("ok").alias("ok"), F.sum(F.when(F.col("ok"), F.col("row_count"))).alias("row_count")
    )
    return cycles.agg(
        F.count(F.lit(1)).alias("attempted_snapshots"),
        F.count_if("ok").alias("successful_snapshots"),
        F.count_if(~F.col("ok")).alias("failed_snapshots"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_collected"),
    )
