"""Ranked and banded report queries. Ties of a top list are broken by key so that it is repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions.rules import (
    HIGH_IMPACT_AVERAGE,
    HIGH_IMPACT_BANDS,
    decile_group,
    sufficiency,
)
from areaflow.operators.aggregate import TRIP, rate
from areaflow.operators.distinct import distinct
from areaflow.runtime import lookup_join, materialize

TOP = 25


def _percent(column: Column) -> Column:
    return F.round(column * 100, 2)


def _average(column: str, rounded: bool) -> Column:
    return (F.round(F.avg(column), 2) if rounded else F.avg(column)).alias(f"avg_{column}")


def _average_rate(rounded: bool) -> Column:
    """Average delay rate, as percentage with two digits or as it is."""
    if rounded:
        return _percent(F.avg("delay_observation_rate")).alias("avg_delay_rate_pct")
    return F.avg("delay_observation_rate").alias("avg_delay_observation_rate")


def top_k(df: DataFrame, measures: list[str], keys: list[str], k: int = TOP) -> DataFrame:
    """Rows with the largest measures, nulls last, ties by key."""
    return df.orderBy(*[F.desc_nulls_last(m) for m in measures], *keys).limit(k)


def top_areas(scores: DataFrame, k: int = TOP, rounded: bool = True) -> DataFrame:
    """Area hours with the highest impact; rounded for reading, or exact for export."""
    top = top_k(scores, ["equity_impact_score"], ["area_code", "snapshot_date", "snapshot_hour"], k)
    impact, delay_rate = F.col("equity_impact_score"), F.col("delay_observation_rate")
    return top.select(
        "area_code",
        "area_name",
        "decile",
        (F.round(impact, 2) if rounded else impact).alias("equity_impact_score"),
        "equity_risk_band",
        "observation_count",
        "delayed_observation_count",
        _percent(delay_rate).alias("delay_rate_pct") if rounded else delay_rate,
        "disruption_alert_count",
    )


def top_routes(route_days: DataFrame, k: int = TOP, with_rate: bool = True) -> DataFrame:
    """Routes with the most delayed observations over all days."""
    observed, delayed = F.sum("observed_trip_update_rows"), F.sum("delayed_observation_count")
    totals = route_days.groupBy("route_id", "route_short_name", "route_long_name").agg(
        observed.alias("total_observations"),
        delayed.alias("total_delayed_observations"),
        *([_percent(rate(delayed, observed)).alias("delay_rate_pct")] if with_rate else []),
        F.sum("disruption_alert_count").alias("total_disruption_alerts"),
        F.max("max_delay_seconds").alias("peak_delay_seconds"),
    )
    return top_k(totals, ["total_delayed_observations"], ["route_id"], k)


def decile_bands(scores: DataFrame, rounded: bool = True) -> DataFrame:
    """Rows, averages and alerts in three groups of deciles; rounded for reading, or exact for export."""
    return (
        scores.where(F.col("decile").isNotNull())
        .groupBy(decile_group(F.col("decile")).alias("decile_band"))
        .agg(
            F.count(F.lit(1)).alias("area_hour_rows"),
            _average("equity_impact_score", rounded),
            _average("disruption_score", rounded),
            _average_rate(rounded),
            F.sum("disruption_alert_count").alias("total_disruption_alerts"),
        )
        .orderBy(F.desc("avg_equity_impact_score"))
    )


def hours(scores: DataFrame, rounded: bool = True) -> DataFrame:
    """Areas, totals and averages per hour, highest impact first; rounded for reading, or exact for export."""
    return (
        scores.groupBy("snapshot_hour")
        .agg(
            F.count_distinct("area_code").alias("area_count"),
            F.sum("observation_count").alias("total_observations"),
            F.sum("delayed_observation_count").alias("total_delayed_observations"),
            _average("equity_impact_score", rounded),
            _average_rate(rounded),
        )
        .orderBy(F.desc_nulls_last("avg_equity_impact_score"))
    )


def quality_counts(scores: DataFrame, delays: DataFrame, alerts: DataFrame) -> DataFrame:
    """Score rows, observations and alerts without an area, and score rows without observations.

    Each table is scanned once; the two counts of the score table are split into rows afterwards.
    """
    score_counts = scores.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("observation_count") == 0).alias("empty")
    ).select(
        F.explode(
            F.array(
                F.struct(F.lit("area_hour_score_rows").alias("dataset"), F.col("n").alias("row_count")),
                F.struct(F.lit("areas_with_zero_observations").alias("dataset"), F.col("empty").alias("row_count")),
            )
        ).alias("r")
    )

    def without_area(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count_if(F.col("area_code").isNull()).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count"
        )

    return (
        score_counts.select("r.*")
        .unionByName(without_area(delays, "delay_rows_missing_area"))
        .unionByName(without_area(alerts, "alert_rows_missing_area"))
    )


def recurring_areas(summary: DataFrame, k: int = TOP) -> DataFrame:
    """Areas with the highest average, then highest single impact."""
    top = top_k(summary, ["avg_equity_impact_score", "max_equity_impact_score"], ["area_code"], k)
    return top.select(
        "area_code",
        "area_name",
        "decile",
        "days_observed",
        "avg_equity_impact_score",
        "max_equity_impact_score",
        "high_or_above_snapshot_rate",
        "avg_delay_observation_rate",
        "peak_equity_risk_band",
    )


def deciles(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy("decile")


def high_impact_areas(summary: DataFrame) -> DataFrame:
    """Areas whose peak band is at least moderate or whose average impact is at least 35."""
    return summary.where(
        F.col("peak_equity_risk_band").isin(*HIGH_IMPACT_BANDS)
        | (F.col("avg_equity_impact_score") >= HIGH_IMPACT_AVERAGE)
    )


def high_impact_codes(summary: DataFrame) -> DataFrame:
    """Codes of the high-impact areas, stored: their size is known, so observations are not shuffled to be joined with few."""
    return materialize(high_impact_areas(summary).select("area_code"), "high-areas")


def delayed_in_high_impact(delays: DataFrame, summary: DataFrame) -> DataFrame:
    """Delayed observations with a route, in high-impact areas. Areas are unique, so a semi-join is enough."""
    late = delays.where(F.col("is_delayed") & F.col("route_id").isNotNull())
    return lookup_join(late, high_impact_codes(summary), "area_code", "left_semi")


def route_contribution(delays: DataFrame, summary: DataFrame, k: int = TOP) -> DataFrame:
    """Routes with the most delayed observations in high-impact areas."""
    totals = (
        delayed_in_high_impact(delays, summary)
        .groupBy("route_id")
        .agg(
            F.count(F.lit(1)).alias("delayed_observations_in_high_impact_areas"),
            F.count_distinct("area_code").alias("high_impact_area_count"),
            F.count_distinct("trip_id").alias("distinct_trip_count"),
            F.avg("max_delay_seconds").alias("avg_max_delay_seconds"),
        )
    )
    return top_k(totals, ["delayed_observations_in_high_impact_areas"], ["route_id"], k)


def route_contribution_of_hours(hours: DataFrame, summary: DataFrame, k: int = TOP) -> DataFrame:
    """route_contribution() from stored delay hours (see aggregate.split_words): the marks of late stops and trips are
    merged by route, no observation is read."""
    late = hours.where(F.col("route_id").isNotNull() & ((F.col("late") > 0) | (F.col("late_bits") != 0)))
    high = lookup_join(late, high_impact_codes(summary), "area_code", "left_semi")
    areas = high.where(F.col("late") > 0).groupBy("route_id", "area_code").agg(F.sum("late").alias("late"), F.sum("late_delay").alias("late_delay"))
    by_area = areas.groupBy("route_id").agg(
        F.sum("late").alias("delayed_observations_in_high_impact_areas"),
        F.count("area_code").alias("high_impact_area_count"),
        rate(F.sum("late_delay"), F.sum("late")).alias("avg_max_delay_seconds"),
    )
    trips = high.where(F.col("kind") == TRIP).groupBy("route_id", "kind", "word", "other").agg(F.bit_or("late_bits").alias("late_bits"))
    totals = by_area.join(trips.groupBy("route_id").agg(distinct(TRIP, "late").alias("distinct_trip_count")), "route_id", "left")
    totals = totals.withColumn("distinct_trip_count", F.coalesce("distinct_trip_count", F.lit(0))).select(
        "route_id", "delayed_observations_in_high_impact_areas", "high_impact_area_count", "distinct_trip_count", "avg_max_delay_seconds"
    )
    return top_k(totals, ["delayed_observations_in_high_impact_areas"], ["route_id"], k)


def hourly_marts(pattern: DataFrame) -> DataFrame:
    return pattern.orderBy("snapshot_hour")


def data_sufficiency(scores: DataFrame, rated: bool = True) -> DataFrame:
    """Days, hours, rows, areas and observations of the score table, and the rating of the days."""
    counts = scores.agg(
        F.count_distinct("snapshot_date").alias("days_in_mart"),
        F.count_distinct("snapshot_hour").alias("hours_in_mart"),
        F.count(F.lit(1)).alias("area_hour_rows"),
        F.count_distinct("area_code").alias("area_count"),
        F.sum("observation_count").alias("total_observations"),
    )
    return counts.withColumn("data_sufficiency", sufficiency(F.col("days_in_mart"))) if rated else counts
