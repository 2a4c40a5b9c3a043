"""Exposure per area and hour, and disruption per route and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow.operators.aggregate import (
    AREA_HOUR,
    ROUTE_DAY,
    area_hour_alerts,
    area_hour_trips,
    rate,
    route_day_alerts,
    route_day_trips,
    routes_per_area,
    stops_per_area,
)
from areaflow.runtime import lookup_join

ALERT_COUNTS = ("service_alert_count", "disruption_alert_count")


def _zero(column: str):
    return F.coalesce(column, F.lit(0)).alias(column)


def outer_measures(trips: DataFrame, alerts: DataFrame, keys: tuple[str, ...], count: str) -> DataFrame:
    """Full outer join of trip and alert measures on equal keys; counts are 0 on the side without rows.

    Both sides are aggregated before, so a key has one row per side at most.
    """
    both = trips.join(alerts, list(keys), "full_outer")
    names = ["area_name"] if "area_name" in trips.columns else []
    return both.select(
        *keys,
        *names,
        _zero(count),
        _zero("distinct_trip_count"),
        _zero("distinct_stop_count"),
        _zero("delayed_observation_count"),
        rate(F.col("delayed_observation_count"), F.col(count)).alias("delay_observation_rate"),
        "avg_arrival_delay_seconds",
        "avg_departure_delay_seconds",
        "max_delay_seconds",
        _zero("major_delay_count"),
        *[_zero(c) for c in ALERT_COUNTS],
    )


def outer_exposure(delays: DataFrame, alerts: DataFrame) -> DataFrame:
    """Trip and alert measures per date, hour and area."""
    return outer_measures(area_hour_trips(delays), area_hour_alerts(alerts), AREA_HOUR, "observation_count")


def outer_route_day(delays: DataFrame, alerts: DataFrame) -> DataFrame:
    """Trip and alert measures per date and route."""
    return outer_measures(route_day_trips(delays), route_day_alerts(alerts), ROUTE_DAY, "observed_trip_update_rows")


def area_counts(stop_map: DataFrame, coverage: DataFrame) -> DataFrame:
    """Stops and routes per area, 0 where an area has none of one kind."""
    both = stops_per_area(stop_map).join(routes_per_area(coverage), "area_code", "full_outer")
    return both.select("area_code", _zero("stop_count"), _zero("route_count"))


def area_hour_exposure(delays: DataFrame, alerts: DataFrame, counts: DataFrame) -> DataFrame:
    """Exposure per date, hour and area with the area's routes and stops (of area_counts())."""
    return with_area_counts(outer_exposure(delays, alerts), counts)


def with_area_counts(exposure: DataFrame, counts: DataFrame) -> DataFrame:
    """Add the routes and stops of the area (of area_counts())."""
    named = counts.withColumnsRenamed({"stop_count": "stops_in_area", "route_count": "routes_serving_area"})
    joined = lookup_join(exposure, named, "area_code")
    return joined.select(*exposure.columns, _zero("routes_serving_area"), _zero("stops_in_area"))


def route_day_disruption(delays: DataFrame, alerts: DataFrame, routes: DataFrame) -> DataFrame:
    """Disruption per date and route with route names; routes unknown to the route table stay."""
    return with_route_names(outer_route_day(delays, alerts), routes)


def with_route_names(measures: DataFrame, routes: DataFrame) -> DataFrame:
    """Add the names of routes."""
    names = routes.select("route_id", "route_short_name", "route_long_name", "route_type")
    joined = lookup_join(measures, names, "route_id")
    return joined.select(*measures.columns, "route_short_name", "route_long_name", "route_type")
