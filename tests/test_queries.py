"""Named queries against their check SQL. AREAFLOW_ALL=1 runs every query, else one of each kind."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from areaflow.checks.registry import CHECK_SQL, QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SOME = (
    "area_hour_trips",
    "join_alert_area",
    "route_area_coverage",
    "observation_base",
    "area_context",
    "area_hour_score",
    "area_multi_day_summary",
    "rpt_top_areas",
    "rpt_route_contribution",
    "stop_area_map",
    "clean_area_index",
    "stg_stops",
    "scan_snapshots",
    "flatten_trip_updates",
    "flatten_alerts",
    "batch_manifest",
    "dq_suite_summary",
    "test_relationships",
    "coverage_summary",
    "stream_dedup",
)
NAMES = tuple(QUERIES) if os.environ.get("AREAFLOW_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR).toPandas()
    assert difference(result, duck.execute(oracle_sql()[name]).df()) is None


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(CHECK_SQL)
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
