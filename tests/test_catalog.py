"""Datasets found by name below a folder, and the record of their files."""

import pytest

from areaflow.plans.build import build
from areaflow.sources import catalog


@pytest.fixture
def root(tmp_path):
    def put(path, text):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text)

    put("gtfs_static/load_date=2026-05-01/trips.txt", "trip_id,route_id,service_id\nT1,R1,C\n")
    put("gtfs_static/load_date=2026-05-08/trips.txt", "trip_id,route_id,service_id\nT1,R1,C\nT2,R1,C\n")
    put("gtfs_static/load_date=2026-05-15/stops.txt", 'stop_id,stop_name,stop_lat,stop_lon\nS1,"a\nb",1,2\n')
    put("gtfs_static/load_date=2026-05-15/other_trips.txt", "trip_id\nT9\n")
    for hour, rows in (("07", "E1,T1\nE2,T2\n"), ("08", ""), ("09", "E2,T2\nE1,T1\n")):
        put(f"gtfs_realtime/feed=trip_updates/hour={hour}/parsed.csv", "entity_id,trip_id\n" + rows)
    put("gtfs_realtime/feed=trip_updates/hour=07/raw.csv", "entity_id,trip_id\nE7,T7\n")
    put("geospatial/deeper/stops_sa2_mapping.csv", "stop_id\nS1\n")
    return str(tmp_path)


def test_rows_of_datasets(spark, root):
    rows = lambda name: catalog.dataset_source(spark, root, name)
    assert sorted(r["trip_id"] for r in rows("trips").collect()) == ["T1", "T2"]
    assert [r["stop_name"] for r in rows("stops").collect()] == ["a\nb"]
    assert sorted(r["entity_id"] for r in rows("trip_updates").collect()) == ["E1", "E1", "E2", "E2"]
    assert all(rows(n) is None for n in ("routes", "service_alerts", "stop_area_map", "area_index"))


def test_record_of_files(spark, root):
    found = {(r["dataset_name"], "/".join(r["source_path"].split("/")[-2:])): r for r in catalog.source_files(spark, root, "b1").collect()}
    assert {k: r["row_count"] for k, r in found.items()} == {
        ("trips", "load_date=2026-05-08/trips.txt"): 2,
        ("stops", "load_date=2026-05-15/stops.txt"): 1,
        ("trip_updates", "hour=07/parsed.csv"): 2,
        ("trip_updates", "hour=08/parsed.csv"): 0,
        ("trip_updates", "hour=09/parsed.csv"): 2,
    }
    sums = [found["trip_updates", f"hour={h}/parsed.csv"]["checksum"] for h in ("07", "08", "09")]
    assert sums[0] == sums[2] != "0" and sums[1] == "0"
    assert len({r["source_file_id"] for r in found.values()}) == 5
    assert all(r["file_size_bytes"] > 0 and r["load_batch_id"] == "b1" for r in found.values())


def test_build_from_a_folder(spark, root, tmp_path):
    manifest = build(spark, catalog.dataset_sources(root), ("trips", "stops", "routes"), str(tmp_path / "out"), "b2")
    rows = {r["dataset"]: (r["row_count"], r["message"]) for r in manifest.collect()}
    assert rows == {"trips": (2, None), "stops": (1, None), "routes": (0, "no source")}
