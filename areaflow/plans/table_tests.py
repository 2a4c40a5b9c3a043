"""Declared tests of the typed tables and models: not null, unique, accepted values, relationships, range."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow.operators.quality import failed_score_range, failed_unique, orphan_keys, result_row
from areaflow.plans.score import FORMULA_VERSION


@dataclass(frozen=True)
class TableTest:
    kind: str
    table: str
    column: str
    values: tuple = ()
    where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# Which columns must be present, unique or from a list.
NOT_NULL = {
    "stops": "stop_id stop_lat stop_lon",
    "routes": "route_id",
    "trips": "trip_id route_id",
    "stop_times": "trip_id stop_id",
    "trip_updates": "entity_id snapshot_timestamp",
    "service_alerts": "entity_id snapshot_timestamp",
    "stop_area_map": "stop_id is_matched",
    "route_area_coverage": "route_id area_code",
    "observation_base": "area_code snapshot_date observation_count",
    "area_index": "area_code score",
    "area_context": "area_code",
    "score_components": "snapshot_date area_code",
    "delay_events": "snapshot_timestamp snapshot_date trip_id",
    "alert_events": "entity_id snapshot_timestamp",
    "route_day_disruption": "service_date route_id",
    "area_hour_exposure": "snapshot_date area_code",
    "area_hour_score": "snapshot_date area_code",
    "hotspots": "area_code",
    "area_day_summary": "snapshot_date area_code",
    "area_multi_day_summary": "area_code days_observed",
    "hourly_pattern": "snapshot_hour",
    "decile_comparison": "decile",
    "route_day_mart": "service_date route_id",
}
UNIQUE = {
    "stops": "stop_id",
    "routes": "route_id",
    "trips": "trip_id",
    "stop_area_map": "stop_id",
    "area_index": "area_code",
    "area_context": "area_code",
    "area_multi_day_summary": "area_code",
    "hourly_pattern": "snapshot_hour",
    "decile_comparison": "decile",
}
ACCEPTED = {
    ("stop_area_map", "is_matched"): (True, False),
    ("delay_events", "delay_severity_band"): ("early_or_on_time", "minor_delay", "moderate_delay", "major_delay"),
    ("alert_events", "alert_severity_band"): ("critical", "high", "moderate", "unknown", "informational"),
    ("score_components", "score_formula_version"): (FORMULA_VERSION,),
    ("area_hour_score", "equity_risk_band"): ("very_high", "high", "moderate", "low", "minimal"),
    ("area_hour_score", "score_formula_version"): (FORMULA_VERSION,),
    ("hourly_pattern", "peak_period_flag"): ("morning_peak", "evening_peak", "midday", "off_peak"),
}
RELATIONSHIPS = {
    ("trips", "route_id"): "routes",
    ("stop_times", "trip_id"): "trips",
    ("stop_times", "stop_id"): "stops",
    ("route_day_disruption", "route_id"): "routes",
}

TABLE_TESTS = (
    *(TableTest("not_null", t, c) for t, columns in NOT_NULL.items() for c in columns.split()),
    TableTest("not_null", "stop_area_map", "area_code", where="is_matched = true"),
    *(TableTest("unique", t, c) for t, columns in UNIQUE.items() for c in columns.split()),
    *(TableTest("accepted", t, c, values) for (t, c), values in ACCEPTED.items()),
    *(TableTest("related", t, c, (parent,)) for (t, c), parent in RELATIONSHIPS.items()),
    TableTest("range", "area_hour_score", "equity_impact_score"),
)


def _row_tests(df: DataFrame, tests: list[TableTest]) -> DataFrame:
    """Not-null and accepted-value tests of one table, all in one aggregate."""
    counts = []
    for i, test in enumerate(tests):
        column = F.col(test.column)
        bad = column.isNull() if test.kind == "not_null" else ~column.isin(*test.values)
        bad = bad & F.expr(test.where) if test.where else bad
        counts.append(F.count_if(bad).alias(f"c{i}"))
    results = [
        F.struct(F.lit(t.name).alias("test"), F.col(f"c{i}").alias("failures")) for i, t in enumerate(tests)
    ]
    rows = df.agg(*counts).select(F.explode(F.array(*results)).alias("r")).select("r.*")
    return rows.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def run_table_tests(tables: dict[str, DataFrame], *kinds: str) -> DataFrame:
    """Rows (test, failures, status) of the declared tests of the given kinds, for the tables given."""
    wanted = [t for t in TABLE_TESTS if t.table in tables and (not kinds or t.kind in kinds)]
    by_table = defaultdict(list)
    results = []
    for test in wanted:
        df = tables[test.table]
        if test.kind in ("not_null", "accepted"):
            by_table[test.table].append(test)
        elif test.kind == "unique":
            results.append(result_row(failed_unique(df, test.column), test.name))
        elif test.kind == "related":
            orphans = orphan_keys(df, test.column, tables[test.values[0]])
            results.append(result_row(orphans, test.name, F.sum("n")))
        else:
            results.append(result_row(failed_score_range(df), test.name))
    results.extend(_row_tests(tables[name], tests) for name, tests in by_table.items())
    return reduce(DataFrame.unionByName, results)
