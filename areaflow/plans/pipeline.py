"""The chain from input tables to the score table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow.operators.aggregate import (
    AREA_HOUR,
    NAME,
    ROUTE_DAY,
    area_hour_alerts,
    area_hour_trips,
    area_hours,
    observation_base,
    route_area_coverage,
    route_day_alerts,
    route_day_trips,
    route_days,
    served_routes,
    split_words,
)
from areaflow.plans.context import area_context
from areaflow.plans.events import alerts_at, area_names, delays_at, stop_lookup, stop_table
from areaflow.plans.exposure import area_counts, outer_measures, with_area_counts, with_route_names
from areaflow.plans.marts import area_multi_day_summary
from areaflow.plans.score import area_hour_score, score_components, stored_bounds, with_scaled
from areaflow.runtime import materialize, materialize_at, scratch_path


@dataclass(frozen=True, eq=False)
class Pipeline:
    """Tables of one run.

    Lookups (stops with their areas, routes of trips) are written once to the shared scratch folder (see
    runtime.materialize) when they are first asked for: the planner then knows their size, so it joins them without
    shuffling observations, and their numbers are fixed. All else is lazy, so that a report computes only what it shows.

    With store, what the score reads more than once is written too: counts, coverage and exposure, the bounds of
    which then come from file footers. With merge_hours, observations become delay hours once for everything (ids and
    measures in a pass each, from the same exchange where one feeds them), which are stored, and area hours, route days and reports follow by merging these. With apart, distinct counts of
    observations and stop times are aggregates of their own, which a query that shows none of them goes without; a query
    that does reads its rows twice."""

    trip_updates: DataFrame
    service_alerts: DataFrame
    stop_area_map: DataFrame
    stops: DataFrame
    routes: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    area_index: DataFrame
    store: bool = False
    merge_hours: bool = False
    apart: bool = False

    def once(self, df: DataFrame, label: str) -> DataFrame:
        return materialize(df, label) if self.store else df

    @cached_property
    def matched(self) -> DataFrame:
        return materialize(stop_lookup(self.stop_area_map), "matched-stops")

    @cached_property
    def stop_areas(self) -> DataFrame:
        """The stop map, unmatched stops included, with the columns that observations and stop times are joined for."""
        return materialize(self.stop_area_map.select("stop_id", "area_code", "area_name", "is_matched"), "stop-areas")

    @cached_property
    def trip_routes(self) -> DataFrame:
        return materialize(self.trips.select("trip_id", "route_id"), "trip-routes")

    @cached_property
    def stop_table(self) -> DataFrame:
        """Area and name per stop, numbered."""
        return stop_table(self.stop_area_map, self.stops)

    @cached_property
    def area_names(self) -> DataFrame:
        """Area names and their numbers."""
        return area_names(self.stop_table)

    @cached_property
    def numbered_delays(self) -> DataFrame:
        return delays_at(self.trip_updates, self.stop_table)

    @cached_property
    def delays(self) -> DataFrame:
        return self.numbered_delays.drop("stop_number", NAME)

    @cached_property
    def alerts(self) -> DataFrame:
        return alerts_at(self.service_alerts, self.matched)

    @cached_property
    def delay_hours(self) -> DataFrame:
        """All observations by hour, area and route, as words that merge (see aggregate.split_words)."""
        return materialize(split_words(self.numbered_delays), "delay-hours")

    @cached_property
    def coverage(self) -> DataFrame:
        rows = route_area_coverage(self.stop_times, self.trips, self.stop_areas, self.routes, self.apart)
        return self.once(rows, "coverage")

    @cached_property
    def observations(self) -> DataFrame:
        """The observation base."""
        return observation_base(self.trip_updates, self.stop_areas, self.apart)

    @cached_property
    def counts(self) -> DataFrame:
        served = served_routes(self.stop_times, self.trip_routes, self.matched.withColumn("is_matched", F.lit(True)))
        return self.once(area_counts(self.stop_area_map, served), "counts")

    @cached_property
    def area_hour_measures(self) -> DataFrame:
        if self.merge_hours:
            delays = area_hours(self.delay_hours, self.area_names)
        else:
            delays = area_hour_trips(self.numbered_delays, self.area_names, self.apart)
        return outer_measures(delays, area_hour_alerts(self.alerts), AREA_HOUR, "observation_count")

    @cached_property
    def route_day_measures(self) -> DataFrame:
        delays = route_days(self.delay_hours) if self.merge_hours else route_day_trips(self.numbered_delays, self.apart)
        return outer_measures(delays, route_day_alerts(self.alerts), ROUTE_DAY, "observed_trip_update_rows")

    @cached_property
    def _exposure(self) -> tuple[DataFrame, DataFrame | None]:
        rows = with_area_counts(self.area_hour_measures, self.counts)
        if not self.store:
            return rows, None
        path = scratch_path(rows.sparkSession, "exposure")
        stored = materialize_at(with_scaled(rows), path)
        return stored.select(*rows.columns), stored_bounds(rows.sparkSession, path)

    @property
    def exposure(self) -> DataFrame:
        return self._exposure[0]

    @property
    def bounds(self) -> DataFrame | None:
        """Bounds of the scaled measures, from the file footers of the stored exposure."""
        return self._exposure[1]

    @cached_property
    def context(self) -> DataFrame:
        return area_context(self.area_index, self.counts)

    @cached_property
    def components(self) -> DataFrame:
        return score_components(self.exposure, self.context, self.bounds)

    @cached_property
    def scores(self) -> DataFrame:
        return area_hour_score(self.exposure, self.context, self.bounds)

    @cached_property
    def route_days(self) -> DataFrame:
        return with_route_names(self.route_day_measures, self.routes)

    @cached_property
    def multi_day(self) -> DataFrame:
        return area_multi_day_summary(self.scores)
