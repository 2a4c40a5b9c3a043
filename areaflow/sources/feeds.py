"""Realtime feed messages (already decoded to nested rows) flattened to observation and alert rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions.parsing import epoch_to_utc, joined_texts

# Schemas of decoded messages, for readers of nested files.
TRANSLATED = "struct<translation: array<struct<text: string>>>"
TRIP_FEED = (
    "header struct<timestamp: bigint>, entity array<struct<id: string, trip_update: struct<"
    "trip: struct<trip_id: string, route_id: string, start_time: string, start_date: string, "
    "schedule_relationship: string>, "
    "stop_time_update: array<struct<stop_sequence: int, stop_id: string, "
    "arrival: struct<delay: int, time: bigint>, departure: struct<delay: int, time: bigint>>>>>>"
)
ALERT_FEED = (
    "header struct<timestamp: bigint>, entity array<struct<id: string, alert: struct<"
    "cause: string, effect: string, active_period: array<struct<start: bigint, end: bigint>>, "
    "informed_entity: array<struct<route_id: string, stop_id: string, trip: struct<trip_id: string>>>, "
    f"header_text: {TRANSLATED}, description_text: {TRANSLATED}>>>"
)

# Effect numbers of the public GTFS-Realtime specification (fixed values).
EFFECT_NAMES = {
    "1": "NO_SERVICE",
    "2": "REDUCED_SERVICE",
    "3": "SIGNIFICANT_DELAYS",
    "4": "DETOUR",
    "5": "ADDITIONAL_SERVICE",
    "6": "MODIFIED_SERVICE",
    "7": "OTHER_EFFECT",
    "8": "UNKNOWN_EFFECT",
    "9": "STOP_MOVED",
    "10": "NO_EFFECT",
    "11": "ACCESSIBILITY_ISSUE",
}


def snapshot_time(header: Column) -> Column:
    """Header time of a feed message; the current time when the header has none."""
    return F.coalesce(epoch_to_utc(F.nullif(header["timestamp"], F.lit(0))), F.current_timestamp())


def _given(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def flatten_trip_updates(messages: DataFrame) -> DataFrame:
    """One row per stop time update; a trip update without any gives one row with nulls."""
    entities = messages.select(snapshot_time(F.col("header")).alias("snapshot_timestamp"), F.explode("entity").alias("e"))
    updates = entities.where("e.trip_update is not null").select(
        "snapshot_timestamp",
        _given(F.col("e.id")).alias("entity_id"),
        F.col("e.trip_update.trip").alias("trip"),
        F.explode_outer("e.trip_update.stop_time_update").alias("s"),
    )
    return updates.select(
        F.lit("trip_updates").alias("feed_name"),
        "snapshot_timestamp",
        "entity_id",
        *[_given(F.col(f"trip.{c}")).alias(c) for c in ("trip_id", "route_id", "start_time", "start_date")],
        F.col("trip.schedule_relationship").alias("schedule_relationship"),
        F.col("s.stop_sequence").alias("stop_sequence"),
        _given(F.col("s.stop_id")).alias("stop_id"),
        F.col("s.arrival.delay").alias("arrival_delay_seconds"),
        epoch_to_utc(F.col("s.arrival.time")).alias("arrival_time"),
        F.col("s.departure.delay").alias("departure_delay_seconds"),
        epoch_to_utc(F.col("s.departure.time")).alias("departure_time"),
    )


def effect_name(effect: Column) -> Column:
    """Effect number as name; names and unknown numbers stay as they are."""
    pairs = [F.lit(x) for pair in EFFECT_NAMES.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), effect), effect)


def flatten_alerts(messages: DataFrame, effect_names: bool = False) -> DataFrame:
    """Active periods times informed entities per alert; an empty list counts as one null element.

    Effects stay as delivered (numbers, in feeds that carry the enum value) unless names are asked for.
    """
    entities = messages.select(snapshot_time(F.col("header")).alias("snapshot_timestamp"), F.explode("entity").alias("e"))
    periods = entities.where("e.alert is not null").select(
        "snapshot_timestamp",
        _given(F.col("e.id")).alias("entity_id"),
        F.col("e.alert").alias("alert"),
        F.explode_outer("e.alert.active_period").alias("p"),
    )
    rows = periods.withColumn("i", F.explode_outer("alert.informed_entity"))
    effect = F.col("alert.effect")
    return rows.select(
        F.lit("service_alerts").alias("feed_name"),
        "snapshot_timestamp",
        "entity_id",
        F.col("alert.cause").alias("cause"),
        (effect_name(effect) if effect_names else effect).alias("effect"),
        epoch_to_utc(F.col("p.start")).alias("active_period_start"),
        epoch_to_utc(F.col("p.end")).alias("active_period_end"),
        _given(F.col("i.route_id")).alias("informed_route_id"),
        _given(F.col("i.stop_id")).alias("informed_stop_id"),
        _given(F.col("i.trip.trip_id")).alias("informed_trip_id"),
        joined_texts(F.col("alert.header_text.translation")).alias("header_text"),
        joined_texts(F.col("alert.description_text.translation")).alias("description_text"),
    )
