"""Grouped measures. Distinct counts are exact and merge (see distinct.py)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.functions.parsing import to_whole
from areaflow.functions.rules import is_late
from areaflow.operators.distinct import Ids, distinct, merged, totalled, with_counts, words
from areaflow.runtime import lookup_join

AREA_HOUR = ("snapshot_date", "snapshot_hour", "area_code")
ROUTE_DAY = ("service_date", "route_id")


def rate(part: Column, whole: Column) -> Column:
    """Ratio as double, null when the whole is zero or null."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


#: The ids counted in observations, in the order of their kinds.
STOP, TRIP = 0, 1


def id_of(rows: DataFrame, name: str, **marks: Column) -> Ids:
    """The id `<name>_id`, by the column `<name>_number` where rows have it."""
    number = F.col(f"{name}_number") if f"{name}_number" in rows.columns else None
    return Ids(number, F.col(f"{name}_id"), marks)


def delay_totals(rows: DataFrame, late: Column) -> dict[str, tuple[str, Column]]:
    """Sums of observations: rows, late rows, and sum and count of both delays."""
    one, totals = F.lit(1).cast("long"), {}
    totals["rows"], totals["late"] = ("sum", one), ("sum", F.coalesce(late, F.lit(False)).cast("long"))
    for name, column in (("arr", "arrival_delay_seconds"), ("dep", "departure_delay_seconds")):
        totals[f"sum_{name}"], totals[f"count_{name}"] = ("sum", F.col(column).cast("long")), ("sum", F.col(column).isNotNull().cast("long"))
    return totals


def mean(name: str) -> Column:
    """Average of a delay from its totals, null without values."""
    return rate(F.sum(f"sum_{name}"), F.sum(f"count_{name}"))


#: Measures of delay_words() and how they combine.
DELAY_MEASURES = {
    **dict.fromkeys(("rows", "late", "sum_arr", "count_arr", "sum_dep", "count_dep", "major", "late_delay"), "sum"),
    "max_delay": "max",
}
#: The number of an area name, in the order of the names.
NAME = "area_name_number"
#: The grain at which a pipeline stores them: every area-hour and every route-day is a union of such groups.
DELAY_GRAIN = (*AREA_HOUR, "route_id")


def word_measures(delays: DataFrame, keys: tuple[str, ...]) -> tuple[tuple[str, ...], dict[str, tuple[str, Column]]]:
    """The keys and measures of classified delays.

    Where delays number their area names in the order of the names (NAME), the largest number is a measure; else the
    name is one more key, since the largest of a text cannot be kept in a hash aggregate.
    """
    late = F.col("is_delayed")
    measures = delay_totals(delays, late) | {
        "major": ("sum", (F.col("delay_severity_band") == "major_delay").cast("long")),
        "late_delay": ("sum", F.when(late, F.col("max_delay_seconds")).cast("long")),
        "max_delay": ("max", F.col("max_delay_seconds")),
    }
    if NAME in delays.columns:
        measures[NAME] = ("max", F.col(NAME))
    elif "area_code" in keys:
        keys = (*keys, "area_name")
    return keys, measures


def delay_words(delays: DataFrame, keys: tuple[str, ...] = DELAY_GRAIN) -> DataFrame:
    """Classified delays by the keys (and the area name, see word_measures()), with stops and trips as words of bits (see
    distinct.words) and marks of the late ones. Any coarser measure follows from them by merging."""
    late = F.col("is_delayed")
    keys, measures = word_measures(delays, keys)
    return words(delays, keys, [id_of(delays, "stop", late=late), id_of(delays, "trip", late=late)], measures)


def id_words(rows: DataFrame, keys: tuple[str, ...], **marks: Column) -> DataFrame:
    """Stops and trips by the keys as words of bits, without measures."""
    return words(rows, keys, [id_of(rows, "stop", **marks), id_of(rows, "trip", **marks)], {})


def merged_delays(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Delay words at coarser keys."""
    name = {c: "max" for c in (NAME, "area_name") if c in rows.columns}
    return merged(rows, keys, DELAY_MEASURES | name)


def merged_apart(rows: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Measures and ids of delay words at coarser keys, each of its own: ids are merged without the measures, and measures
    without the many rows of trips."""
    values = {c: (how, F.col(c)) for c, how in DELAY_MEASURES.items()}
    if "area_code" in keys and NAME in rows.columns:
        values[NAME] = ("max", F.col(NAME))
    grain = (*keys, "area_name") if "area_code" in keys and "area_name" in rows.columns else keys
    return totalled(rows.where(F.col("rows").isNotNull()), grain, values), merged(rows.select(*keys, "kind", "word", "other", "bits"), keys, {})


def words_apart(delays: DataFrame, keys: tuple[str, ...], **marks: Column) -> tuple[DataFrame, DataFrame]:
    """Measures and ids of classified delays by the keys, each of its own."""
    grain, measures = word_measures(delays, keys)
    return totalled(delays, grain, measures), id_words(delays, keys, **marks)


def split_words(delays: DataFrame, keys: tuple[str, ...] = DELAY_GRAIN) -> DataFrame:
    """delay_words() with the measures in rows that have no id.

    Ids come once a row where they do not repeat, so the hash table that combines them in a task is as long as its rows;
    without the measures it is half as wide, and stays in memory. Delays are classified twice, from the same exchange where one feeds them.
    """
    totals, ids = words_apart(delays, keys, late=F.col("is_delayed"))
    kind = totals.withColumns({"kind": F.lit(STOP), "word": F.lit(None).cast("long"), "other": F.lit(None).cast("string")})
    return kind.unionByName(ids, allowMissingColumns=True)


def delay_measures(rows: DataFrame, keys: tuple[str, ...], count_name: str, *more: Column, ids: DataFrame | None = None) -> DataFrame:
    """Measures by the keys, over delay words merged at those keys, or over measures alone with their `ids` apart."""
    counts = [distinct(TRIP).alias("distinct_trip_count"), distinct(STOP).alias("distinct_stop_count")]
    found = rows.groupBy(*keys).agg(
        *more,
        F.sum("rows").alias(count_name),
        *(counts if ids is None else []),
        F.sum("late").alias("delayed_observation_count"),
        mean("arr").alias("avg_arrival_delay_seconds"),
        mean("dep").alias("avg_departure_delay_seconds"),
        F.max("max_delay").alias("max_delay_seconds"),
        F.sum("major").alias("major_delay_count"),
    )
    if ids is None:
        return found
    at = found.columns.index(count_name) + 1
    order = [*found.columns[:at], "distinct_trip_count", "distinct_stop_count", *found.columns[at:]]
    return with_counts(found, ids, keys, counts).select(*order)


def alert_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("service_alert_count"),
        F.count_if("is_disruption_alert").alias("disruption_alert_count"),
    ]


def area_hour_measures(rows: DataFrame, names: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Delay measures by date, hour and area from delay words at that grain, of observations with an area; the area name
    is the largest one among the observations (by its number in `names`, where delays number it)."""
    if names is None:
        return delay_measures(rows, AREA_HOUR, "observation_count", F.max("area_name").alias("area_name"), ids=ids)
    found = lookup_join(delay_measures(rows, AREA_HOUR, "observation_count", F.max(NAME).alias(NAME), ids=ids), names, NAME)
    return found.select(*AREA_HOUR, "area_name", *[c for c in found.columns if c not in (*AREA_HOUR, "area_name", NAME)])


def area_hours(rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Delay measures by date, hour and area from stored delay words."""
    totals, ids = merged_apart(rows.where(F.col("area_code").isNotNull()), AREA_HOUR)
    return area_hour_measures(totals, names, ids)


def area_hour_trips(delays: DataFrame, names: DataFrame | None = None, apart: bool = False) -> DataFrame:
    """Delay measures by date, hour and area, over observations with an area. With `apart` the distinct counts are an
    aggregate of their own (see distinct.with_counts): for queries that show none of them."""
    rows = delays.where(F.col("area_code").isNotNull())
    if apart:
        totals, ids = words_apart(rows, AREA_HOUR)
        return area_hour_measures(totals, names, ids)
    found = delay_words(rows, AREA_HOUR)
    return area_hour_measures(found if names is not None else merged_delays(found, AREA_HOUR), names)


def area_hour_alerts(alerts: DataFrame) -> DataFrame:
    """Alert counts by date, hour and area, over alerts with an area."""
    return alerts.where(F.col("area_code").isNotNull()).groupBy(*AREA_HOUR).agg(*alert_measures())


def route_day_measures(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Delay measures by date and route from delay words at that grain."""
    day = {"snapshot_date": "service_date"}
    ids = ids if ids is None else ids.withColumnsRenamed(day)
    return delay_measures(rows.withColumnsRenamed(day), ROUTE_DAY, "observed_trip_update_rows", ids=ids)


def route_days(rows: DataFrame) -> DataFrame:
    """Delay measures by date and route from stored delay words, of observations with a route: hours and areas merge,
    no observation is read."""
    return route_day_measures(*merged_apart(rows.where(F.col("route_id").isNotNull()), ("snapshot_date", "route_id")))


def route_day_trips(delays: DataFrame, apart: bool = False) -> DataFrame:
    """Delay measures by date and route, over observations with a route; for `apart` see area_hour_trips()."""
    rows, keys = delays.where(F.col("route_id").isNotNull()), ("snapshot_date", "route_id")
    return route_day_measures(*words_apart(rows, keys)) if apart else route_day_measures(delay_words(rows, keys))


def route_day_alerts(alerts: DataFrame) -> DataFrame:
    """Alert counts by date and informed route."""
    rows = alerts.where(F.col("informed_route_id").isNotNull()).withColumnsRenamed(
        {"snapshot_date": "service_date", "informed_route_id": "route_id"}
    )
    return rows.groupBy(*ROUTE_DAY).agg(*alert_measures())


def stops_per_area(stop_map: DataFrame) -> DataFrame:
    """Distinct matched stops per area."""
    return stop_map.where("is_matched = true").groupBy("area_code").agg(F.count_distinct("stop_id").alias("stop_count"))


def routes_per_area(coverage: DataFrame) -> DataFrame:
    """Distinct routes per area."""
    return coverage.groupBy("area_code").agg(F.count_distinct("route_id").alias("route_count"))


def served_routes(stop_times: DataFrame, trips: DataFrame, stop_map: DataFrame) -> DataFrame:
    """Each route and area with a stop time at a matched stop, once."""
    areas = stop_map.where("is_matched = true").select("stop_id", "area_code")
    located = lookup_join(stop_times.select("trip_id", "stop_id"), areas, "stop_id", "inner").select("trip_id", "area_code")
    return located.join(trips.select("trip_id", "route_id"), "trip_id").select("route_id", "area_code").distinct()


def covered_stop_times(stop_times: DataFrame, trips: DataFrame, stop_map: DataFrame) -> DataFrame:
    """Stop times at matched stops with the trip's route; stop times without a trip keep a null route."""
    areas = stop_map.where("is_matched = true").select("stop_id", "area_code", "area_name")
    located = lookup_join(stop_times.select("trip_id", "stop_id", "stop_sequence"), areas, "stop_id", "inner")
    return located.join(trips.select("trip_id", "route_id"), "trip_id", "left")


def route_area_coverage(
    stop_times: DataFrame, trips: DataFrame, stop_map: DataFrame, routes: DataFrame, apart: bool = False
) -> DataFrame:
    """Stops, trips and stop sequence range per route and area; for `apart` see area_hour_trips().

    Grouping by route id first means that route names are joined to the few result rows instead of to
    every stop time. A route id with several different names gives one row for each, as grouping by name does.
    """
    sequence = F.col("stop_sequence")
    is_text = isinstance(stop_times.schema["stop_sequence"].dataType, T.StringType)
    rows = covered_stop_times(stop_times, trips, stop_map).withColumn(
        "stop_sequence", to_whole(sequence) if is_text else sequence.cast("bigint")
    )
    keys, measures = ("route_id", "area_code", "area_name"), {name: (how, F.col("stop_sequence")) for name, how in (("first", "min"), ("last", "max"))}
    counts = [distinct(STOP).alias("stop_count_in_area"), distinct(TRIP).alias("trip_count_serving_area")]
    found = totalled(rows, keys, measures) if apart else words(rows, keys, [id_of(rows, "stop"), id_of(rows, "trip")], measures)
    grouped = found.groupBy(*keys).agg(
        *([] if apart else counts),
        F.min("first").alias("first_stop_sequence"),
        F.max("last").alias("last_stop_sequence"),
    )
    if apart:
        grouped = with_counts(grouped, id_words(rows, keys), keys, counts)
    names = routes.select("route_id", "route_short_name", "route_long_name", "route_type").distinct()
    return lookup_join(grouped, names, "route_id").select(
        "route_id",
        "route_short_name",
        "route_long_name",
        "route_type",
        "area_code",
        "area_name",
        "stop_count_in_area",
        "trip_count_serving_area",
        "first_stop_sequence",
        "last_stop_sequence",
    )


def coverage_report(coverage: DataFrame) -> DataFrame:
    return coverage.agg(
        F.count(F.lit(1)).alias("coverage_rows"),
        F.count_distinct("route_id").alias("distinct_routes"),
        F.count_distinct("area_code").alias("distinct_areas"),
    )


def observations_with_area(trip_updates: DataFrame, stop_map: DataFrame) -> DataFrame:
    """Observations at a stop with the stop's area; a stop without a map row counts as unmatched."""
    areas = stop_map.select("stop_id", "area_code", "area_name", "is_matched")
    observed = trip_updates.where(F.col("stop_id").isNotNull())
    return lookup_join(observed, areas, "stop_id").withColumn("is_matched", F.coalesce("is_matched", F.lit(False)))


def observation_base(trip_updates: DataFrame, stop_map: DataFrame, apart: bool = False) -> DataFrame:
    """Observations by date, hour and area, with the group of no area kept; for `apart` see area_hour_trips()."""
    late = is_late(F.col("arrival_delay_seconds")) | is_late(F.col("departure_delay_seconds"))
    time = F.col("snapshot_timestamp")
    rows = observations_with_area(trip_updates, stop_map).withColumns(
        {"snapshot_date": F.to_date(time).cast("string"), "snapshot_hour": F.hour(time)}
    )
    keys = ("snapshot_date", "snapshot_hour", "area_code", "area_name")
    measures = delay_totals(rows, late) | {
        "entities": ("sum", F.col("entity_id").isNotNull().cast("long")),
        "unmatched": ("sum", (~F.col("is_matched")).cast("long")),
        "max_arr": ("max", F.col("arrival_delay_seconds")),
        "max_dep": ("max", F.col("departure_delay_seconds")),
    }
    found = totalled(rows, keys, measures) if apart else words(rows, keys, [id_of(rows, "stop"), id_of(rows, "trip")], measures)
    counts = [distinct(TRIP).alias("distinct_trip_count"), distinct(STOP).alias("distinct_stop_count")]
    base = found.groupBy(*keys).agg(
        F.sum("entities").alias("observation_count"),
        *([] if apart else counts),
        F.sum("late").alias("delayed_observation_count"),
        mean("arr").alias("avg_arrival_delay_seconds"),
        mean("dep").alias("avg_departure_delay_seconds"),
        F.max("max_arr").alias("max_arrival_delay_seconds"),
        F.max("max_dep").alias("max_departure_delay_seconds"),
        F.sum("unmatched").alias("unmatched_stop_observation_count"),
    )
    if not apart:
        return base
    rest = [c for c in base.columns if c not in (*keys, "observation_count")]
    joined = with_counts(base, id_words(rows, keys), keys, counts)
    return joined.select(*keys, "observation_count", "distinct_trip_count", "distinct_stop_count", *rest)


def observation_report(trip_updates: DataFrame, stop_map: DataFrame) -> DataFrame:
    """Totals of matched and unmatched observations."""
    rows = observations_with_area(trip_updates, stop_map)
    return rows.agg(
        F.count(F.lit(1)).alias("total_observations"),
        F.count_if("is_matched").alias("matched_observations"),
        F.count_if(~F.col("is_matched")).alias("unmatched_observations"),
    )


def min_max(df: DataFrame, **measures: Column) -> DataFrame:
    """One row with min_<name> and max_<name> of each measure."""
    bounds = [f(c).alias(f"{f.__name__}_{name}") for name, c in measures.items() for f in (F.min, F.max)]
    return df.agg(*bounds)
