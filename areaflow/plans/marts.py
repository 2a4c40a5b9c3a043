"""Reporting tables on top of the area and hour score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions.rules import HIGH_BANDS, peak_period, risk_band
from areaflow.operators.aggregate import rate
from areaflow.operators.distinct import days_and_hours

HOTSPOT_COLUMNS = (
    "snapshot_date",
    "snapshot_hour",
    "area_code",
    "area_name",
    "decile",
    "disadvantage_weight",
    "observation_count",
    "delayed_observation_count",
    "delay_observation_rate",
    "disruption_alert_count",
    "disruption_score",
    "equity_impact_score",
    "equity_risk_band",
    "score_formula_version",
    "calculated_at",
)
ROUTE_COLUMNS = (
    "service_date",
    "route_id",
    "observed_trip_update_rows",
    "distinct_trip_count",
    "distinct_stop_count",
    "delayed_observation_count",
    "delay_observation_rate",
    "avg_arrival_delay_seconds",
    "avg_departure_delay_seconds",
    "max_delay_seconds",
    "major_delay_count",
    "service_alert_count",
    "disruption_alert_count",
    "route_short_name",
    "route_long_name",
    "route_type",
)


def _sum(column: str, name: str | None = None) -> Column:
    return F.sum(column).alias(name or column)


def _avg(column: str) -> Column:
    return F.avg(column).alias(f"avg_{column}")


def _largest(*columns: str) -> list[Column]:
    return [F.max(c).alias(c) for c in columns]


def hotspots(scores: DataFrame) -> DataFrame:
    return scores.select(*HOTSPOT_COLUMNS)


def route_day_mart(route_days: DataFrame) -> DataFrame:
    return route_days.select(*ROUTE_COLUMNS)


def hourly_pattern(scores: DataFrame) -> DataFrame:
    """Areas, average rate and impact and delayed observations per hour, with the peak period."""
    return (
        scores.groupBy("snapshot_hour")
        .agg(
            F.count_distinct("area_code").alias("observed_area_count"),
            _avg("delay_observation_rate"),
            _avg("equity_impact_score"),
            _sum("delayed_observation_count", "total_delayed_observations"),
        )
        .withColumn("peak_period_flag", peak_period(F.col("snapshot_hour")))
    )


def area_day_summary(scores: DataFrame) -> DataFrame:
    """Day totals per area. peak_equity_risk_band is the last band in text order, kept for its users;
    peak_band_by_score is the band of the highest score."""
    observed, delayed = F.sum("observation_count"), F.sum("delayed_observation_count")
    return scores.groupBy("snapshot_date", "area_code").agg(
        *_largest("area_name", "decile", "disadvantage_weight"),
        observed.alias("observation_count"),
        delayed.alias("delayed_observation_count"),
        rate(delayed, observed).alias("delay_observation_rate"),
        _sum("disruption_alert_count"),
        _avg("disruption_score"),
        _avg("equity_impact_score"),
        F.max("equity_impact_score").alias("max_equity_impact_score"),
        F.max("equity_risk_band").alias("peak_equity_risk_band"),
        risk_band(F.max("equity_impact_score")).alias("peak_band_by_score"),
        *_largest("score_formula_version", "calculated_at"),
    )


def area_multi_day_summary(scores: DataFrame) -> DataFrame:
    """Days, hours, average and highest impact and recurrence of high bands per area.

    Days and hours are counted in words of bits (see distinct.py), which ride with the sums; there is no Expand.
    """
    averages = ("equity_impact_score", "delay_observation_rate", "disruption_score")
    largest = ("area_name", "decile", "disadvantage_weight", "score_formula_version", "equity_impact_score")
    measures = {f"largest_{c}": ("max", F.col(c)) for c in largest}
    for c in averages:
        measures |= {f"sum_{c}": ("sum", F.col(c)), f"count_{c}": ("sum", F.col(c).isNotNull().cast("long"))}
    measures["rows"] = ("sum", F.lit(1).cast("long"))
    measures["high"] = ("sum", F.coalesce(F.col("equity_risk_band").isin(*HIGH_BANDS), F.lit(False)).cast("long"))
    found = days_and_hours(scores, "area_code", "snapshot_date", "snapshot_hour", measures)
    average = {c: rate(F.col(f"sum_{c}"), F.col(f"count_{c}")).alias(f"avg_{c}") for c in averages}
    return found.select(
        "area_code",
        *[F.col(f"largest_{c}").alias(c) for c in largest[:3]],
        F.col("days").alias("days_observed"),
        F.col("hours").alias("snapshot_hours_observed"),
        average["equity_impact_score"],
        F.col("largest_equity_impact_score").alias("max_equity_impact_score"),
        F.col("high").alias("high_or_above_snapshot_count"),
        rate(F.col("high"), F.col("rows")).alias("high_or_above_snapshot_rate"),
        average["delay_observation_rate"],
        average["disruption_score"],
        F.col("largest_score_formula_version").alias("score_formula_version"),
        risk_band(F.col("largest_equity_impact_score")).alias("peak_equity_risk_band"),
    )


def decile_comparison(scores: DataFrame) -> DataFrame:
    """Areas, averages and totals per decile, over rows that have one."""
    return (
        scores.where(F.col("decile").isNotNull())
        .groupBy("decile")
        .agg(
            F.count_distinct("area_code").alias("area_count"),
            _avg("equity_impact_score"),
            _avg("disruption_score"),
            _avg("delay_observation_rate"),
            _sum("observation_count", "total_observations"),
            _sum("delayed_observation_count", "total_delayed_observations"),
        )
    )
