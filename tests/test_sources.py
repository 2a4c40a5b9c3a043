"""Text files, snapshot directories, nested feeds, loads, manifests and streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from areaflow.checks import tables
from areaflow.contracts import get_contract
from areaflow.fixtures import Tables
from areaflow.operators import coverage, standardize
from areaflow.sources import feeds, files, sinks
from areaflow.streaming import streams


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_text_files_align_by_name(spark, tmp_path):
    write(tmp_path / "a" / "x.csv", "stop_id,stop_name\n007,\n")
    write(tmp_path / "b" / "y.csv", "zone_id,stop_id\nZ,008\n")
    rows = files.scan_all_string(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()
    assert {tuple(r) for r in rows} == {("007", "", None), ("008", None, "Z")}


def test_newest_load(spark, tmp_path):
    write(tmp_path / "load_date=2026-05-21" / "stops.txt", "stop_id\n1\n2\n")
    write(tmp_path / "load_date=2026-05-28" / "stops.txt", "stop_id\n3\n")
    assert [tuple(r) for r in files.latest_load(spark, str(tmp_path)).collect()] == [("3", "2026-05-28")]


def test_snapshots_and_quiet_files(spark, tmp_path):
    base = "feed=trip_updates/year=2026/month=05/day=28/hour=07"
    write(tmp_path / base / "minute=00" / "parsed.csv", "entity_id\ne1\ne2\n")
    write(tmp_path / base / "minute=15" / "parsed.csv", "entity_id\n")
    write(tmp_path / base.replace("trip_updates", "service_alerts") / "minute=00" / "parsed.csv", "entity_id\na1\n")
    rows = files.scan_snapshots(spark, str(tmp_path), "trip_updates", "entity_id string").select("entity_id", "hour", "minute")
    assert {tuple(r) for r in rows.collect()} == {("e1", 7, 0), ("e2", 7, 0)}
    listed = files.partition_parts(files.snapshot_files(spark, str(tmp_path)))
    labelled = files.with_source_label(spark.read.option("header", True).csv(str(tmp_path)).drop("feed"), "file_path")
    counted = coverage.snapshot_rows(files.partition_parts(labelled), listed)
    counts = {(r["feed"], r["snapshot_timestamp"].minute): (r["row_count"], r["is_quiet"]) for r in counted.collect()}
    assert counts == {
        ("trip_updates", 0): (2, False), ("trip_updates", 15): (0, True), ("service_alerts", 0): (1, False),
    }
    row = coverage.coverage_summary(counted).first()
    assert (row["total_snapshots"], row["days_covered"], row["weekday_days_covered"]) == (3, 1, 1)
    assert (row["morning_peak_snapshots"], row["trip_update_row_count"], row["service_alert_row_count"]) == (3, 2, 1)
    assert row["data_sufficiency_rating"] == "exploratory" and row["evidence_label"] == "exploratory"
    by = {(r["dimension"], r["value"]): r["snapshots"] for r in coverage.coverage_by(counted).collect()}
    assert by["feed", "trip_updates"] == 2 and by["hour", "7"] == 3 and by["date", "2026-05-28"] == 3


def test_coverage_of_nothing(frame):
    row = coverage.coverage_summary(frame("feed string, snapshot_timestamp timestamp, row_count long")).first()
    assert row["total_snapshots"] == 0 and row["data_sufficiency_rating"] == "insufficient"
    assert row["recommended_next_action"].startswith("Too few days")


def test_evidence_rule(frame):
    def snapshots(days, hours):
        rows = [(f, datetime(2026, 5, d, h)) for d in range(1, days + 1) for h in hours for f in ("trip_updates", "service_alerts")]
        return frame("feed string, snapshot_timestamp timestamp", *rows)

    assert coverage.evidence_ready(snapshots(7, (7, 17))).first()["is_evidence_ready"]
    assert not coverage.evidence_ready(snapshots(6, (7, 17))).first()["is_evidence_ready"]
    assert not coverage.evidence_ready(snapshots(7, (7, 12))).first()["is_evidence_ready"]
    one_feed = snapshots(7, (7, 8, 16, 17)).where("feed = 'trip_updates'")
    assert not coverage.evidence_ready(one_feed).first()["is_evidence_ready"]


def test_collection_log(frame):
    log = frame("cycle int, ok boolean, row_count long", (1, True, 5), (1, False, 0), (2, False, 0), (3, True, 0))
    assert coverage.collection_summary(log).first().asDict() == {
        "attempted_snapshots": 3, "successful_snapshots": 2, "failed_snapshots": 1, "rows_collected": 5,
    }


def messages(spark, tmp_path, schema, *payloads):
    write(tmp_path / "feed.json", "\n".join(json.dumps(p) for p in payloads))
    return spark.read.schema(schema).json(str(tmp_path / "feed.json"))


def test_trip_feed_keeps_updates_without_stops(spark, tmp_path):
    update = {"stop_sequence": 1, "stop_id": "s1", "arrival": {"delay": 120}}
    payload = {
        "header": {"timestamp": 1700000000},
        "entity": [
            {"id": "e1", "trip_update": {"trip": {"trip_id": "t1", "route_id": ""}, "stop_time_update": [update]}},
            {"id": "e2", "trip_update": {"trip": {"trip_id": "t2"}, "stop_time_update": []}},
            {"id": "e3"},
        ],
    }
    rows = {r["entity_id"]: r for r in feeds.flatten_trip_updates(messages(spark, tmp_path, feeds.TRIP_FEED, payload)).collect()}
    assert set(rows) == {"e1", "e2"}
    assert rows["e1"]["arrival_delay_seconds"] == 120 and rows["e1"]["route_id"] is None
    assert rows["e2"]["stop_id"] is None and rows["e2"]["trip_id"] == "t2"
    assert str(rows["e1"]["snapshot_timestamp"]) == "2023-11-14 22:13:20"


def test_alert_feed_multiplies_periods_and_entities(spark, tmp_path):
    texts = {"translation": [{"text": "Hello"}, {"text": ""}, {"text": "Bonjour"}]}
    payload = {
        "header": {"timestamp": 0},
        "entity": [
            {"id": "a1", "alert": {"effect": "4", "header_text": texts}},
            {
                "id": "a2",
                "alert": {
                    "effect": "NO_SERVICE",
                    "active_period": [{"start": 1, "end": 2}, {"start": 3}],
                    "informed_entity": [{"route_id": "r1"}, {"stop_id": "s1"}, {"trip": {"trip_id": "t"}}],
                },
            },
        ],
    }
    source = messages(spark, tmp_path, feeds.ALERT_FEED, payload)
    rows = feeds.flatten_alerts(source).collect()
    plain = [r for r in rows if r["entity_id"] == "a1"]
    assert len(plain) == 1 and plain[0]["effect"] == "4" and plain[0]["header_text"] == "Hello | Bonjour"
    assert plain[0]["informed_route_id"] is None and plain[0]["description_text"] is None
    assert plain[0]["snapshot_timestamp"].year >= 2024
    assert len(rows) == 7
    named = feeds.flatten_alerts(source, effect_names=True)
    assert {r["effect"] for r in named.collect()} == {"DETOUR", "NO_SERVICE"}


def test_loads(spark, frame, tmp_path):
    contract = get_contract("routes")
    raw = frame("route_id string, route_short_name string", ("r1", " "), ("r2", "2"))
    rows = standardize.standardize(raw, contract, "routes.txt", "b1")
    for _ in range(2):
        sinks.load_table(rows, contract, str(tmp_path / "append"))
        sinks.load_table(rows, contract, str(tmp_path / "replace"), replace=True)
        sinks.load_table(rows, contract, str(tmp_path / "batch"), per_batch=True)
    sinks.load_table(rows.withColumn("load_batch_id", F.lit("b2")), contract, str(tmp_path / "batch"), per_batch=True)
    counts = {m: sinks.loaded_count(spark, str(tmp_path / m)).first()[0] for m in ("append", "replace", "batch")}
    assert counts == {"append": 4, "replace": 2, "batch": 4}
    stored = spark.read.parquet(str(tmp_path / "replace"))
    assert stored.where("route_id = 'r1'").first()["route_short_name"] is None
    assert stored.where("loaded_at is null").isEmpty() and "agency_id" in stored.columns


def test_manifest(frame):
    good = frame("trip_id string, route_id string, service_id string", ("t", "r", "s"))
    bad = frame("stop_id string", ("1",), ("1",))
    tables = {"trips": (get_contract("trips"), good, 1), "stops": (get_contract("stops"), bad, 2)}
    rows = {r["dataset"]: r for r in sinks.batch_manifest(tables, "b").collect()}
    assert rows["trips"]["errors"] == 0 and rows["stops"]["errors"] == 3 and rows["stops"]["warnings"] == 1
    assert {r["records_loaded"] for r in rows.values()} == {3}
    assert {r["status"] for r in rows.values()} == {"completed_with_errors"}
    only = sinks.batch_manifest({"trips": tables["trips"]}, sinks.new_batch_id()).first()
    assert only["status"] == "success"


def test_run_record_is_appended(spark, frame, tmp_path):
    good = frame("trip_id string, route_id string, service_id string", ("t", "r", "s"))
    manifest = sinks.batch_manifest({"trips": (get_contract("trips"), good, 1)}, "b")
    run = sinks.ingestion_run(manifest, "builder", F.lit("2026-05-28").cast("timestamp"), "in")
    for _ in range(2):
        sinks.append_audit(run, str(tmp_path / "runs"))
    rows = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert [(r["run_id"], r["status"], r["records_loaded"]) for r in rows] == [("b", "success", 1)] * 2


def test_export_is_one_file_with_header(spark, tmp_path):
    df = spark.range(5).repartition(3).orderBy(F.desc("id")).limit(3)
    path = sinks.export_result(df, str(tmp_path / "report"), one_file=True)
    parts = list((tmp_path / "report").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().split() == ["id", "4", "3", "2"]
    assert spark.read.option("header", True).csv(path).count() == 3


def test_stream_reads_each_file_once_and_drops_redelivered_rows(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    rows = spark.range(6).select(
        F.concat(F.lit("e"), F.col("id") % 3).alias("entity_id"),
        F.lit(1).alias("stop_sequence"),
        F.timestamp_seconds(F.col("id") % 2 * 60 + 1_780_000_000).alias("snapshot_timestamp"),
    )
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        streams.run_deduplicated(streams.read_snapshots(spark, source, rows.schema), out, state)
    stored = spark.read.parquet(out).select("entity_id", "stop_sequence", "snapshot_timestamp")
    keys = [tuple(r) for r in stored.collect()]
    assert len(keys) == len(set(keys)) == 6


def test_text_with_quotes_breaks_and_outer_blanks_comes_back(spark, frame, tmp_path):
    rows = [("1", ' pad "q", '), ("2", "two\nlines"), ("3", 'a "b"'), ("4", "")]
    path = sinks.write_partitioned(frame("id string, t string", *rows), str(tmp_path / "t"), file_format="csv")
    assert sorted(map(tuple, files.scan_all_string(spark, path).collect())) == rows


def test_newest_load_of_one_file(spark, tmp_path):
    for date, name, text in (("1", "stops.txt", "s\na"), ("1", "routes.txt", "r\nb"), ("2", "routes.txt", "r\nc")):
        (tmp_path / f"load_date={date}").mkdir(exist_ok=True)
        (tmp_path / f"load_date={date}" / name).write_text(text)
    assert [tuple(r) for r in files.latest_load(spark, str(tmp_path), "stops.txt").collect()] == [("a", "1")]
    assert [tuple(r) for r in files.latest_load(spark, str(tmp_path), "routes.txt").collect()] == [("c", "2")]


def test_paths_are_parsed_once_and_not_for_every_row(spark, tmp_path, monkeypatch):
    spark.sql("select id as l_orderkey, id % 3 as l_linenumber, id as l_partkey, id as l_suppkey from range(200)").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select id as o_orderkey, id as o_custkey from range(200)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("select id as event_id, id as user_id, 'click' as event_type from range(50)").write.parquet(f"{tmp_path}/events.parquet")
    counted, parts = [], files.partition_parts
    monkeypatch.setattr(files, "partition_parts", lambda df: counted.append(df) or parts(df))
    rows = tables.partition_parts(Tables(spark, str(tmp_path)))
    assert counted[0].count() == counted[0].select("file_path").distinct().count()
    assert rows.groupBy().sum("n").first()[0] == 250
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in plan and "csv" not in plan


def test_snapshot_parts_of_a_time(frame):
    rows = frame("k int, t string", (1, "2026-05-01 03:04:59"), (2, None), (3, "0987-12-31 23:00:00"), (4, "+12026-01-02 00:09:00"))
    found = files.with_snapshot_parts(rows.withColumn("snapshot_timestamp", F.to_timestamp("t"))).orderBy("k").drop("t", "snapshot_timestamp", "k").collect()
    patterns = ("yyyy", "MM", "dd", "HH", "mm")
    each = rows.withColumn("s", F.to_timestamp("t")).orderBy("k").select(*[F.date_format("s", p) for p in patterns]).collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in each]
