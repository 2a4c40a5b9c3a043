"""Data-quality rules, table tests, freshness and reconciliation."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from areaflow.contracts import get_contract
from areaflow.operators import quality
from areaflow.plans.table_tests import TABLE_TESTS, run_table_tests


def found(df):
    return {(r["check"], r["column"]): (r["severity"], r["affected"]) for r in df.collect()}


def test_valid_stops_pass(frame):
    df = frame("stop_id string, stop_name string, stop_lat string, stop_lon string", ("101", "Central", "-37.8", "144.9"))
    assert {severity for severity, _ in found(quality.check_dataset(df, get_contract("stops"))).values()} == {"passed"}


def test_missing_columns_are_errors(frame):
    checks = found(quality.check_dataset(frame("stop_id string", ("101",)), get_contract("stops")))
    assert checks["required_present", "stop_lat"] == ("error", 1)
    assert checks["required_present", "stop_id"] == ("passed", 0)


def test_delay_out_of_range_is_a_warning(frame):
    df = frame(
        "feed_name string, snapshot_timestamp string, entity_id string, stop_sequence string, arrival_delay_seconds string, "
        "departure_delay_seconds string",
        ("trip_updates", "2026-05-28T07:00:00+00:00", "e1", "1", "99999", "0"),
    )
    checks = found(quality.check_dataset(df, get_contract("trip_updates")))
    assert checks["delay_range", "arrival_delay_seconds"] == ("warning", 1)
    assert checks["delay_range", "departure_delay_seconds"] == ("passed", 0)
    assert checks["timestamp_parse", "snapshot_timestamp"] == ("passed", 0)


def test_empty_tables(frame):
    stops = frame("stop_id string, stop_name string, stop_lat string, stop_lon string")
    checks = found(quality.check_dataset(stops, get_contract("stops")))
    assert checks["row_count", None] == ("error", 0)
    # An empty table has no entirely-null columns to complain about.
    assert checks["all_null", "stop_id"] == ("passed", 0)
    alerts = frame("feed_name string, snapshot_timestamp string, entity_id string")
    assert found(quality.check_dataset(alerts, get_contract("service_alerts")))["row_count", None] == ("warning", 0)


def test_blank_text_counts_as_null_unless_told_otherwise(frame):
    df = frame("feed_name string, snapshot_timestamp string, entity_id string", ("f", "", "e"), ("f", "", "e"))
    contract = get_contract("service_alerts")
    strict = found(quality.check_dataset(df, contract))
    assert strict["all_null", "snapshot_timestamp"] == ("error", 2)
    assert strict["timestamp_parse", "snapshot_timestamp"] == ("passed", 0)
    loose = found(quality.check_dataset(df, contract, blank_is_null=False))
    assert loose["all_null", "snapshot_timestamp"] == ("passed", 0)
    assert loose["timestamp_parse", "snapshot_timestamp"] == ("warning", 2)
    assert strict["duplicate_key", "entity_id"] == ("warning", 2)


def test_duplicates_count_every_copy_and_null_keys(frame):
    df = frame("stop_id string", ("1",), ("1",), ("2",), (None,), (None,))
    assert quality.duplicate_rows(df, ("stop_id",)).first()[0] == 4


def test_coordinates_and_matched_stops(frame):
    df = frame(
        "stop_id string, stop_lat string, stop_lon string, is_matched string, area_code string",
        ("1", "1", "1", "true", None), ("2", "999", "1", "no", None), ("3", None, "1", "YES", "206011097"),
    )
    checks = found(quality.check_dataset(df, get_contract("stop_area_map")))
    assert checks["coordinates", "stop_lat"] == ("warning", 2)
    assert checks["matched_has_area", "area_code"] == ("error", 1)


def test_area_index_rules(frame):
    df = frame(
        "area_code string, area_name string, release_year int, score double",
        ("206011097", "Melbourne", 2021, 980.1), ("© Commonwealth of Australia 2023 and more", "Footer", 2021, None),
    )
    checks = found(quality.check_dataset(df, get_contract("area_index")))
    assert checks["code_format", "area_code"] == ("error", 1)
    assert checks["code_length", "area_code"] == ("error", 1)
    assert checks["score_missing", "score"] == ("error", 1)


def test_dataset_report_and_summary(frame):
    df = frame("stop_id string, stop_name string, stop_lat double, stop_lon double", ("1", None, 1.0, 1.0), ("1", "A", 1.0, 1.0))
    row = quality.dataset_report(df, get_contract("stops")).first()
    assert row["row_count"] == 2 and row["null_counts"]["stop_name"] == 1 and row["duplicate_rows"] == 2
    summary = quality.suite_summary(quality.suite({"stops": (get_contract("stops"), df)})).first()
    assert (summary["warnings"], summary["errors"]) == (1, 0)


def test_row_level_tests(frame):
    df = frame("k string, ok boolean, v string", ("1", True, None), ("1", False, None), ("2", True, "x"))
    assert quality.failed_not_null(df, "v").count() == 2
    assert quality.failed_not_null(df, "v", F.col("ok")).count() == 1
    assert [tuple(r) for r in quality.failed_unique(df, "k").collect()] == [("1", 2)]
    assert [tuple(r) for r in quality.failed_accepted(df, "k", ("2",)).collect()] == [("1", 2)]
    orphans = quality.orphan_keys(df, "k", frame("id string", ("2",)), "id")
    assert [tuple(r) for r in orphans.collect()] == [("1", 2)]


def test_score_range(frame):
    df = frame("equity_impact_score double", (-1.0,), (0.0,), (100.0,), (100.5,), (None,))
    assert quality.failed_score_range(df).count() == 2


def test_declared_tests(frame):
    assert len(TABLE_TESTS) == 66
    tables = {
        "trips": frame("trip_id string, route_id string", ("t1", "r1"), ("t1", "r9"), (None, None)),
        "routes": frame("route_id string", ("r1",)),
    }
    results = {r["test"]: (r["failures"], r["status"]) for r in run_table_tests(tables).collect()}
    assert results == {
        "not_null_trips_trip_id": (1, "fail"),
        "not_null_trips_route_id": (1, "fail"),
        "not_null_routes_route_id": (0, "pass"),
        "unique_trips_trip_id": (1, "fail"),
        "unique_routes_route_id": (0, "pass"),
        "related_trips_route_id": (1, "fail"),
    }


@pytest.mark.parametrize("day, status", [(29, "pass"), (20, "warn"), (10, "error")])
def test_freshness(frame, day, status):
    df = frame("prepared_at timestamp", (datetime(2026, 5, day),), (datetime(2026, 1, 1),))
    as_of = F.lit("2026-05-30").cast("timestamp")
    assert quality.source_freshness(df, as_of).first()["status"] == status


def test_reconciliation(frame):
    source = frame("dataset string, row_count long", ("a", 2), ("b", 1), ("c", 0), ("d", 3))
    output = frame("dataset string, row_count long", ("a", 2), ("b", 2), ("c", 0), ("e", 5))
    entries = quality.reconcile_counts(source, output)
    assert {r["dataset"]: (r["delta"], r["status"]) for r in entries.collect()} == {
        "a": (0, "match"), "b": (1, "mismatch"), "c": (0, "both_empty"), "d": (-3, "mismatch"), "e": (0, "both_empty"),
    }
    assert quality.reconcile_summary(entries).first().asDict() == {
        "matches": 1, "mismatches": 2, "missing_outputs": 1, "missing_sources": 1,
    }
