"""Delay events and alert events: observations enriched with area, flags and bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areaflow.functions.rules import alert_band, delay_band, is_disruption, is_late, max_delay
from areaflow.operators.aggregate import NAME
from areaflow.operators.distinct import numbered
from areaflow.runtime import lookup_join, materialize

LINEAGE = ("warehouse_dataset", "source_file", "prepared_at")


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def matched_stops(stop_map: DataFrame) -> DataFrame:
    """Stops that were matched to an area."""
    return stop_map.where("is_matched = true")


def stop_lookup(stop_map: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """Area and name per stop; the map's name comes first, the stop table's name is the fallback.

    Joining the two small tables with each other first leaves one join on the observations. Stops that
    appear more than once on either side fan out as they would in two left joins.
    """
    mapped = matched_stops(stop_map).select("stop_id", "stop_name", "area_code", "area_name")
    if stops is None:
        return mapped
    names = stops.select("stop_id", F.col("stop_name").alias("_name"))
    both = mapped.join(names, "stop_id", "full_outer")
    return both.select("stop_id", F.coalesce("stop_name", "_name").alias("stop_name"), "area_code", "area_name")


def stop_table(stop_map: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """stop_lookup(), stored, with a number for each stop, and for each area name in the order of the names (there
    are as many as areas, so one task ranks them)."""
    names = stop_lookup(stop_map).where("area_name is not null").select("area_name").distinct()
    ranked = names.withColumn(NAME, F.row_number().over(Window.orderBy("area_name")).cast("bigint"))
    return materialize(numbered(lookup_join(stop_lookup(stop_map, stops), ranked, "area_name"), "stop_id", "stop_number"), "stop-table")


def area_names(stops: DataFrame) -> DataFrame:
    """Area names of a stop_table() and their numbers."""
    return stops.where(F.col(NAME).isNotNull()).select("area_name", NAME).distinct()


def with_snapshot_parts(df: DataFrame) -> DataFrame:
    """Date and hour of the snapshot time, in the session zone (UTC)."""
    time = F.col("snapshot_timestamp")
    return df.withColumns({"snapshot_date": F.to_date(time), "snapshot_hour": F.hour(time)})


def delay_events(trip_updates: DataFrame, stop_map: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """One row per trip update observation with area, largest delay, delay flags and band."""
    return delays_at(trip_updates, stop_lookup(stop_map, stops))


def delays_at(trip_updates: DataFrame, lookup: DataFrame) -> DataFrame:
    """Delay events by a table of stop_lookup(); a stored one has a known size, so that the planner itself decides
    whether observations are shuffled for the join. Its further columns are carried along."""
    more = [c for c in lookup.columns if c not in ("stop_id", "stop_name", "area_code", "area_name")]
    arrival, departure = F.col("arrival_delay_seconds"), F.col("departure_delay_seconds")
    largest = max_delay(arrival, departure)
    observed = with_snapshot_parts(trip_updates).withColumns(
        {
            "max_delay_seconds": largest,
            "is_arrival_delayed": is_late(arrival),
            "is_departure_delayed": is_late(departure),
            "is_delayed": is_late(largest),
            "delay_severity_band": delay_band(largest),
        }
    )
    return lookup_join(observed, lookup, "stop_id").select(
        "snapshot_timestamp",
        "snapshot_date",
        "snapshot_hour",
        "route_id",
        "trip_id",
        "stop_id",
        "stop_name",
        "area_code",
        "area_name",
        "arrival_delay_seconds",
        "departure_delay_seconds",
        "max_delay_seconds",
        "is_arrival_delayed",
        "is_departure_delayed",
        "is_delayed",
        "delay_severity_band",
        *_lineage(trip_updates),
        *more,
    )


def alert_events(service_alerts: DataFrame, stop_map: DataFrame) -> DataFrame:
    """One row per alert row with area, disruption flag and band. Effects are matched by name."""
    return alerts_at(service_alerts, stop_lookup(stop_map))


def alerts_at(service_alerts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Alert events by a table of stop_lookup()."""
    lookup = lookup.select(F.col("stop_id").alias("informed_stop_id"), "area_code", "area_name")
    flagged = with_snapshot_parts(service_alerts).withColumns(
        {
            "is_disruption_alert": is_disruption(F.col("effect")),
            "alert_severity_band": alert_band(F.col("effect")),
        }
    )
    optional = ("cause", "informed_trip_id", "active_period_start", "active_period_end", "header_text", "description_text")
    return lookup_join(flagged, lookup, "informed_stop_id").select(
        "snapshot_timestamp",
        "snapshot_date",
        "snapshot_hour",
        "entity_id",
        "effect",
        "informed_route_id",
        "informed_stop_id",
        "area_code",
        "area_name",
        "is_disruption_alert",
        "alert_severity_band",
        *[c for c in optional if c in service_alerts.columns],
        *_lineage(service_alerts),
    )
