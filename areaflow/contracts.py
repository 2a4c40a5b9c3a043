"""The ten table contracts: columns, logical and stored types, keys and rules."""

from __future__ import annotations

from dataclasses import dataclass

METADATA_COLUMNS = ("warehouse_dataset", "source_file", "prepared_at", "load_batch_id")
TABLE_ONLY_COLUMNS = ("loaded_at",)

STORED_TYPES = {"string": "string", "integer": "int", "float": "double", "boolean": "boolean", "timestamp": "timestamp"}

# Header names, best first, under which a logical column may arrive (fixed values).
AREA_CODE_NAMES = (
    "SA2_CODE21",
    "SA2_MAIN21",
    "SA2_MAINCODE_2021",
    "SA2_CODE_2021",
    "SA2_MAINCODE",
    "sa2_code",
    "area_code",
)
AREA_NAME_NAMES = ("SA2_NAME21", "SA2_NAME_2021", "SA2_NAME", "sa2_name", "area_name")
SCORE_NAMES = (
    "irsd_score",
    "index_of_relative_socioeconomic_disadvantage",
    "index_of_relative_socio-economic_disadvantage",
    "irsd",
    "irsd score",
    "score",
)
DECILE_NAMES = ("irsd_decile", "decile", "irsd decile")
PERCENTILE_NAMES = ("irsd_percentile", "percentile", "irsd percentile")
RELEASE_YEAR_NAMES = ("seifa_release_year", "release_year")

COLUMN_NAMES = {
    "area_code": AREA_CODE_NAMES,
    "area_name": AREA_NAME_NAMES,
    "score": SCORE_NAMES,
    "decile": DECILE_NAMES,
    "percentile": PERCENTILE_NAMES,
    "release_year": RELEASE_YEAR_NAMES,
    "stop_count_in_area": ("stop_count_in_sa2", "stop_count_in_area"),
    "trip_count_serving_area": ("trip_count_serving_sa2", "trip_count_serving_area"),
    "source_areas_path": ("source_sa2_path", "source_areas_path"),
}


@dataclass(frozen=True)
class Contract:
    """One table: logical column types in order, natural key, required columns and flags."""

    name: str
    domain: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    columns: dict[str, str]
    decimals: dict[str, str]
    allow_empty: bool = False
    delay_checked: bool = False

    @property
    def times(self) -> tuple[str, ...]:
        return tuple(c for c, kind in self.columns.items() if kind == "timestamp")

    def stored_type(self, column: str) -> str:
        return self.decimals.get(column, STORED_TYPES[self.columns[column]])

    @property
    def table_columns(self) -> tuple[str, ...]:
        extra = [c for c in (*METADATA_COLUMNS, *TABLE_ONLY_COLUMNS) if c not in self.columns]
        return (*self.columns, *extra)

    def table_type(self, column: str) -> str:
        if column in self.columns:
            return self.stored_type(column)
        return "timestamp" if column in ("prepared_at", "loaded_at") else "string"

    @property
    def table_schema_ddl(self) -> str:
        return ", ".join(f"`{c}` {self.table_type(c)}" for c in self.table_columns)


def _contract(name, domain, key, required, columns, decimals=None, **flags) -> Contract:
    pairs = (entry.split() for entry in columns.split(","))
    return Contract(
        name, domain, tuple(key.split()), tuple(required.split()), {c: t for c, t in pairs}, decimals or {}, **flags
    )


COORDINATES = {"stop_lat": "decimal(10,7)", "stop_lon": "decimal(10,7)"}
DELAYS = {
    f"{kind}_{event}_delay_seconds": "decimal(12,4)" for kind in ("avg", "max") for event in ("arrival", "departure")
}

CONTRACTS = {
    c.name: c
    for c in (
        _contract(
            "stops",
            "gtfs_static",
            "stop_id",
            "stop_id stop_name stop_lat stop_lon",
            "stop_id string, stop_name string, stop_lat float, stop_lon float, location_type integer, "
            "parent_station string, wheelchair_boarding integer, zone_id string",
            COORDINATES,
        ),
        _contract(
            "routes",
            "gtfs_static",
            "route_id",
            "route_id route_short_name route_long_name route_type",
            "route_id string, route_short_name string, route_long_name string, route_type integer, "
            "agency_id string, route_color string, route_text_color string",
        ),
        _contract(
            "trips",
            "gtfs_static",
            "trip_id",
            "trip_id route_id service_id",
            "trip_id string, route_id string, service_id string, trip_headsign string, direction_id integer, "
            "shape_id string, block_id string, wheelchair_accessible integer, bikes_allowed integer",
        ),
        _contract(
            "stop_times",
            "gtfs_static",
            "trip_id stop_sequence",
            "trip_id stop_id stop_sequence arrival_time departure_time",
            "trip_id string, stop_id string, stop_sequence integer, arrival_time string, departure_time string, "
            "pickup_type integer, drop_off_type integer, stop_headsign string, shape_dist_traveled float",
            {"shape_dist_traveled": "decimal(12,4)"},
        ),
        _contract(
            "trip_updates",
            "gtfs_realtime",
            "entity_id stop_sequence",
            "feed_name snapshot_timestamp entity_id",
            "feed_name string, snapshot_timestamp timestamp, entity_id string, trip_id string, route_id string, "
            "start_time string, start_date string, schedule_relationship string, stop_sequence integer, "
            "stop_id string, arrival_delay_seconds integer, arrival_time timestamp, "
            "departure_delay_seconds integer, departure_time timestamp",
            allow_empty=True,
            delay_checked=True,
        ),
        _contract(
            "service_alerts",
            "gtfs_realtime",
            "entity_id",
            "feed_name snapshot_timestamp entity_id",
            "feed_name string, snapshot_timestamp timestamp, entity_id string, cause string, effect string, "
            "active_period_start timestamp, active_period_end timestamp, informed_route_id string, "
            "informed_stop_id string, informed_trip_id string, header_text string, description_text string",
            allow_empty=True,
        ),
        _contract(
            "stop_area_map",
            "geospatial",
            "stop_id",
            "stop_id stop_name stop_lat stop_lon area_code area_name is_matched",
            "stop_id string, stop_name string, stop_lat float, stop_lon float, area_code string, area_name string, "
            "mapping_method string, is_matched boolean, mapping_created_at timestamp, "
            "source_stops_path string, source_areas_path string",
            COORDINATES,
        ),
        _contract(
            "route_area_coverage",
            "geospatial",
            "route_id area_code",
            "route_id area_code area_name",
            "route_id string, route_short_name string, route_long_name string, route_type integer, "
            "area_code string, area_name string, stop_count_in_area integer, trip_count_serving_area integer, "
            "first_stop_sequence integer, last_stop_sequence integer, coverage_created_at timestamp",
        ),
        _contract(
            "observation_base",
            "analytics",
            "snapshot_date snapshot_hour area_code",
            "snapshot_date snapshot_hour area_code observation_count",
            "snapshot_date string, snapshot_hour integer, area_code string, area_name string, "
            "observation_count integer, distinct_trip_count integer, distinct_stop_count integer, "
            "delayed_observation_count integer, avg_arrival_delay_seconds float, avg_departure_delay_seconds float, "
            "max_arrival_delay_seconds float, max_departure_delay_seconds float, "
            "unmatched_stop_observation_count integer",
            DELAYS,
            allow_empty=True,
            delay_checked=True,
        ),
        _contract(
            "area_index",
            "equity",
            "area_code",
            "area_code area_name release_year score",
            "area_code string, area_name string, release_year integer, score float, decile float, "
            "percentile float, source_file string, prepared_at timestamp",
            {"score": "decimal(12,6)", "decile": "decimal(8,2)", "percentile": "decimal(8,2)"},
            allow_empty=True,
        ),
    )
}

GROUPS = {
    "gtfs_static": ("stops", "routes", "trips", "stop_times"),
    "gtfs_realtime": ("trip_updates", "service_alerts"),
    "geospatial": ("stop_area_map", "route_area_coverage"),
    "equity": ("area_index",),
    "analytics": ("observation_base",),
}


#: Every name that stands for datasets: groups, single datasets, and "all".
DATASETS = {"all": tuple(CONTRACTS), **GROUPS, **{name: (name,) for name in CONTRACTS}}


def get_contract(name: str) -> Contract:
    """The contract of one dataset; KeyError for any other name."""
    return CONTRACTS[name]


def resolve_datasets(name: str) -> tuple[str, ...]:
    """The datasets that a name stands for (see DATASETS)."""
    listed = DATASETS.get(name)
    if listed is None:
        raise ValueError(f"{name!r} is none of {', '.join(DATASETS)}")
    return listed
