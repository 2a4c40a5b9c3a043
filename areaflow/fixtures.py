"""Adapter: transit tables derived from the given parquet tables, as SQL text valid in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.plans.pipeline import Pipeline

# name -> (source tables and filter, select list).
DERIVED = {
    "areas": (
        "{nation}",
        """cast(200000000+n_nationkey as string) as area_code, n_name as area_name,
        cast(n_nationkey % 5 as double) as x0, cast(floor(n_nationkey / 5) as double) as y0""",
    ),
    "area_index": (
        "{nation}",
        """cast(200000000+n_nationkey as string) as area_code, n_name as area_name, 2021 as release_year,
        case when n_nationkey % 20 = 0 then null else cast(800 + (n_nationkey*37) % 400 as double) end as score,
        case when n_nationkey % 5 = 0 then null else cast(1 + n_nationkey % 10 as double) end as decile,
        case when n_nationkey % 10 = 0 then null else cast(1 + (n_nationkey*17) % 100 as double) end as percentile""",
    ),
    "stops": (
        "{supplier}",
        """'S' || cast(s_suppkey as string) as stop_id, s_name as stop_name,
        cast(case when s_suppkey % 13 = 0 then 999.0 else floor(s_nationkey/5) + 0.1 + 0.8*((s_suppkey*37)%100)/100.0 end as double) as stop_lat,
        cast(case when s_suppkey % 17 = 0 then -20.0 else (s_nationkey%5) + 0.1 + 0.8*((s_suppkey*53)%100)/100.0 end as double) as stop_lon,
        cast(s_suppkey % 2 as int) as location_type,
        case when s_suppkey % 3 = 0 then null else 'P' || cast(s_suppkey % 40 as string) end as parent_station,
        cast(s_suppkey % 3 as int) as wheelchair_boarding, 'Z' || cast(s_nationkey as string) as zone_id""",
    ),
    "stop_area_map": (
        "{supplier} join {nation} on s_nationkey=n_nationkey",
        """'S' || cast(s_suppkey as string) as stop_id, s_name as stop_name,
        case when s_suppkey%13=0 or s_suppkey%17=0 then null else cast(200000000+n_nationkey as string) end as area_code,
        case when s_suppkey%13=0 or s_suppkey%17=0 then null else n_name end as area_name,
        not (s_suppkey%13=0 or s_suppkey%17=0) as is_matched,
        case when s_suppkey%13=0 then 'invalid_coordinates' else 'within' end as mapping_method""",
    ),
    # areas of many corners, round a centre at changing distance, with a hole, and places among them
    "area_corners": (
        "(select *, row_number() over (partition by c_nationkey order by c_custkey) as k, count(*) over (partition by c_nationkey) as m from {customer})",
        """cast(200000000+c_nationkey as string) as area_code, 0 as ring, cast(k as int) as k,
        round(10*(c_nationkey % 5) + (3 + cast((c_custkey*37)%100 as double)/50) * cos(2*pi()*k/m), 6) as x,
        round(10*floor(c_nationkey/5) + (3 + cast((c_custkey*37)%100 as double)/50) * sin(2*pi()*k/m), 6) as y""",
    ),
    "area_holes": (
        "{nation} cross join (values (0, 1.5, 0.0), (1, 0.0, 1.5), (2, -1.5, 0.0), (3, 0.0, -1.5)) as v(k, dx, dy)",
        """cast(200000000+n_nationkey as string) as area_code, 1 as ring, k,
        cast(10*(n_nationkey % 5) + dx as double) as x, cast(10*floor(n_nationkey/5) + dy as double) as y""",
    ),
    "places": (
        "{orders}",
        """'O' || cast(o_orderkey as string) as place, cast((o_orderkey*7919) % 50000 as double)/1000 - 5 as x,
        cast((cast(o_custkey as bigint)*104729 + o_orderkey*31) % 50000 as double)/1000 - 5 as y""",
    ),
    "routes": (
        "{part}",
        """distinct 'R' || cast(p_partkey % 24 as string) as route_id, 'L' || cast(p_partkey % 24 as string) as route_short_name,
        'Line ' || cast(p_partkey % 24 as string) as route_long_name, 2 as route_type,
        'A' || cast(p_partkey % 3 as string) as agency_id""",
    ),
    "trips": (
        "{orders}",
        """'T' || cast(o_orderkey as string) as trip_id, 'R' || cast(o_custkey % 24 as string) as route_id,
        'C' || cast(o_custkey % 7 as string) as service_id, 'To ' || o_orderpriority as trip_headsign,
        cast(o_orderkey % 2 as int) as direction_id""",
    ),
    "stop_times": (
        "{lineitem}",
        """'T' || cast(l_orderkey as string) as trip_id, 'S' || cast(l_suppkey as string) as stop_id,
        l_linenumber as stop_sequence, cast(4 + (l_orderkey*3 + l_linenumber) % 24 as string) || ':15:00' as arrival_time,
        cast(4 + (l_orderkey*3 + l_linenumber) % 24 as string) || ':16:00' as departure_time,
        cast(l_partkey % 4 as int) as pickup_type, l_quantity * 100 as shape_dist_traveled""",
    ),
    "trip_updates": (
        "{lineitem} join {orders} on l_orderkey=o_orderkey",
        """timestamp '2026-05-01 00:00:00' + interval '1' hour * cast((l_orderkey*7+l_linenumber)%336 as int) as snapshot_timestamp,
        'E' || cast(l_orderkey as string) as entity_id, 'T' || cast(l_orderkey as string) as trip_id,
        case when l_orderkey%97=0 then null else 'R' || cast(o_custkey % 24 as string) end as route_id,
        l_linenumber as stop_sequence,
        case when l_partkey%101=0 then null else 'S' || cast(l_suppkey + (case when l_partkey%53=0 then 1000000 else 0 end) as string) end as stop_id,
        case when l_partkey%11=0 then null else cast((l_partkey*31+l_orderkey*17)%2200-600 as int) end as arrival_delay_seconds,
        case when l_suppkey%7=0 then null else cast((l_partkey*13+l_orderkey*29)%2200-600 as int) end as departure_delay_seconds,
        'trip_updates' as feed_name""",
    ),
    "service_alerts": (
        "{events}",
        """timestamp '2026-05-01 00:00:00' + interval '1' hour * cast((event_id*5)%336 as int) as snapshot_timestamp,
        'A' || cast(event_id as string) as entity_id,
        case event_type when 'error' then 'NO_SERVICE' when 'click' then 'DETOUR' when 'signup' then 'significant_delays' when 'view' then 'UNKNOWN_EFFECT' else null end as effect,
        case when event_id%4=0 then null else 'R' || cast(user_id%30 as string) end as informed_route_id,
        case when event_id%3=0 then null else 'S' || cast(user_id%120 as string) end as informed_stop_id,
        'service_alerts' as feed_name, 'CAUSE_' || cast(event_id % 5 as string) as cause""",
    ),
}




RINGS = """array(array(named_struct('x', x0, 'y', y0), named_struct('x', x0 + 1, 'y', y0),
    named_struct('x', x0 + 1, 'y', y0 + 1), named_struct('x', x0, 'y', y0 + 1)))"""


def derived_sql(name: str) -> str:
    """The derivation as plain SQL over the given table names."""
    source, columns = DERIVED[name]
    return f"select {columns} from {source}".replace("{", "").replace("}", "")


class Tables:
    """The given tables of one directory and the transit tables derived from them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        """A given table; its schema is read once."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def derived(self, name: str) -> DataFrame:
        source, columns = DERIVED[name]
        frames = {t: self.given(t) for t in re.findall(r"{(\w+)}", source)}
        return self.spark.sql(f"select {columns} from {source}", **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DERIVED:
            raise AttributeError(name)
        return self.derived(name)

    @property
    def area_polygons(self) -> DataFrame:
        return self.areas.select("area_code", "area_name", F.expr(RINGS).alias("rings"))

    @property
    def winding_areas(self) -> DataFrame:
        """The areas of many corners, with their rings as the spatial operators take them."""
        corners = F.array_sort(F.collect_list(F.struct("k", "x", "y")))
        rings = self.area_corners.unionByName(self.area_holes).groupBy("area_code", "ring").agg(F.transform(corners, lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))).alias("corners"))
        return rings.groupBy("area_code").agg(F.lit("winding").alias("area_name"), F.collect_list("corners").alias("rings"))

    def pipeline(self, **options: bool) -> Pipeline:
        names = ("trip_updates", "service_alerts", "stop_area_map", "stops", "routes", "trips", "stop_times", "area_index")
        return Pipeline(**{name: self.derived(name) for name in names}, **options)
