"""Re-delivered and late rows of streams: keyed state, its timers, and the hours that are read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaflow.operators.aggregate import area_hour_trips
from areaflow.plans.events import delay_events
from areaflow.streaming import seen, streams

KIND = "entity_id string, stop_sequence int, snapshot_timestamp timestamp, route_id string, trip_id string, stop_id string, arrival_delay_seconds int, departure_delay_seconds int"
START = dt.datetime(2026, 5, 1, tzinfo=dt.timezone.utc)
HOURS = 3_600_000


def row(entity, hour, delay=0, stop="s1"):
    time = None if hour is None else START + dt.timedelta(hours=hour)
    return (f"e{entity}", 1, time, "r1", f"t{entity}", stop, delay, None)


@pytest.fixture
def deliver(spark, frame, tmp_path):
    """Write rows as one more file of the source, then run the stream over what is new."""
    places = {name: f"file://{tmp_path}/{name}" for name in ("in", "store", "state")}

    def run(*rows, **more):
        if rows:
            frame(KIND, *rows).coalesce(1).write.mode("append").parquet(places["in"])
        stream = streams.read_snapshots(spark, places["in"], KIND, files_per_batch=1)
        streams.run_deduplicated(stream, places["store"], places["state"], **more)
        return sorted((r["entity_id"], str(r["snapshot_hour"]), r["arrival_delay_seconds"]) for r in spark.read.parquet(places["store"]).collect())

    run.places = places
    return run


def test_redelivery_is_recognised_at_any_age(deliver):
    first = [row(k, k % 3) for k in range(9)] + [row(9, None)]
    one = deliver(*first, *first[:4])
    assert len(one) == 10
    assert deliver(*first[:5], row(20, 1)) == sorted([*one, ("e20", "1", 0)])  # in state
    later = deliver(row(30, 24 * 9))  # the clock moves on by nine days: keys of the first hours are let go
    assert len(later) == 12
    assert deliver(*first, row(40, 2), row(9, None)) == sorted([*later, ("e40", "2", 0)])  # days later: from the store
    assert deliver(*first, row(40, 2), row(30, 24 * 9)) == sorted([*later, ("e40", "2", 0)])
    assert deliver() == sorted([*later, ("e40", "2", 0)])


def test_rows_that_differ_within_a_batch(deliver):
    assert deliver(row(1, 0, 5), row(1, 0, 9), row(1, 0, None), order="arrival_delay_seconds") == [("e1", "0", 9)]
    assert deliver(row(1, 0, 50), order="arrival_delay_seconds") == [("e1", "0", 9)]  # the first delivery stays


def test_times_that_differ_by_a_microsecond_are_two_keys(deliver):
    first = row(1, 0)
    assert len(deliver(first, (*first[:2], first[2] + dt.timedelta(microseconds=1), *first[3:]), first)) == 2


def test_batch_that_runs_again_stores_nothing_twice(spark, frame, deliver):
    deliver(row(1, 0), row(2, 1))
    rows = frame(KIND, row(3, 1), row(1, 0)).withColumn(seen.SHARE["whole"], F.lit(False))
    for _ in range(2):  # as after a failure between storing and committing
        hours = seen.store_batch(rows, 7, deliver.places["store"])
        assert [tuple(h) for h in hours] == [(START.date(), 1)]
    assert sorted(r[0] for r in spark.read.parquet(deliver.places["store"]).select("entity_id").collect()) == ["e1", "e2", "e3"]


def test_new_checkpoint_for_an_old_store_is_an_error(spark, deliver, tmp_path):
    deliver(row(1, 0))
    stream = streams.read_snapshots(spark, deliver.places["in"], KIND)
    with pytest.raises(ValueError, match="is new"):
        streams.run_deduplicated(stream, deliver.places["store"], f"file://{tmp_path}/other")


def test_only_touched_hours_are_read(spark, frame, deliver):
    deliver(*[row(k, k) for k in range(40)], row(50, None))
    stored = seen.stored_rows(spark, deliver.places["store"], frame(KIND, row(1, 0)).schema)

    def files(rows):
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
        return plan, sum(leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size()))

    day = START.date()
    plan, read = files(seen.in_hours(stored, [(day, 3), (day, 4), (None, None)]))
    assert read == 3 and "PartitionFilters: [((" in plan.replace("PartitionFilters: [(((", "PartitionFilters: [((")
    assert files(stored)[1] == 41
    assert seen.in_hours(stored, [(day, 3), (None, None)]).count() == 2


def test_area_hours_equal_a_batch_run(spark, frame, tmp_path):
    stops = frame("stop_id string, stop_name string, area_code string, area_name string, is_matched boolean", ("s1", "S", "a", "A", True))
    places = {name: f"file://{tmp_path}/{name}" for name in ("in", "store", "state", "out")}
    deliveries = [[row(k, k % 4, 100 * k) for k in range(12)], [row(k, k % 4, 100 * k) for k in range(6, 18)], [row(99, 24 * 30, 700)], [row(3, 3, 300), row(77, 0, 999)]]
    every = {}
    for rows in deliveries:
        every.update({(r[0], r[2]): r for r in rows})
        frame(KIND, *rows).coalesce(1).write.mode("append").parquet(places["in"])
        stream = streams.read_snapshots(spark, places["in"], KIND, files_per_batch=1)
        streams.run_area_hours(stream, stops, places["store"], places["out"], places["state"])
    expected = area_hour_trips(delay_events(frame(KIND, *every.values()), stops))
    found = spark.read.schema(expected.schema).parquet(places["out"]).select(*expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_hours_are_handed_on_once_for_all_batches_and_again_after_a_failure(spark, frame, tmp_path):
    places = {name: f"file://{tmp_path}/{name}" for name in ("in", "store", "state")}
    calls, before = [], spark.conf.get("spark.sql.shuffle.partitions")

    def run(after):
        stream = streams.read_snapshots(spark, places["in"], KIND, files_per_batch=1)
        seen.run_new_rows(stream, places["store"], places["state"], after)

    def note(rows, hours):
        calls.append((rows.count(), sorted(h["snapshot_hour"] for h in hours)))

    def fail(rows, hours):
        raise RuntimeError("no room")

    for k in range(3):  # three files, three batches
        frame(KIND, row(k, 1), row(10 + k, 2)).coalesce(1).write.mode("append").parquet(places["in"])
    run(note)
    assert calls == [(6, [1, 2])]
    frame(KIND, row(20, 2), row(0, 1)).coalesce(1).write.mode("append").parquet(places["in"])
    with pytest.raises(RuntimeError, match="no room"):
        run(fail)
    run(note)
    run(note)
    assert calls == [(6, [1, 2]), (4, [2])]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_new_rows_of_a_run_are_found_at_once(spark, frame):
    arrived = frame(f"{KIND}, {seen.BATCH} long", *[(*r, n) for r, n in ((row(1, 0, 5), 1), (row(1, 0, 9), 1), (row(1, 0, 70), 2), (row(1, 1, 7), 2), (row(2, 0), 2), (row(3, None), 3), (row(3, None), 1), (row(4, None, 1), 1))])
    stored = seen.with_hour(frame(KIND, row(2, 0, 60), row(4, None, 60), row(1, 2))).withColumn(seen.BATCH, F.lit(0).cast("long"))
    found = seen.fresh_rows(arrived, stored, order="arrival_delay_seconds")
    assert found.columns == arrived.drop(seen.BATCH).columns
    kept = [(r["entity_id"], str(r["snapshot_timestamp"] or "")[11:13], r["arrival_delay_seconds"]) for r in found.collect()]
    assert sorted(kept) == [("e1", "00", 9), ("e1", "01", 7), ("e3", "", 0)]
    many = {int(START.timestamp()) // 3600: 3, seen.NO_HOUR: 2}
    assert sorted(seen.fresh_rows(arrived, stored, order="arrival_delay_seconds", buckets=many).collect(), key=str) == sorted(found.collect(), key=str)
    whole = seen.fresh_rows(arrived, stored, tuple(arrived.drop(seen.BATCH).columns))
    assert sorted(r["arrival_delay_seconds"] for r in whole.collect()) == [0, 0, 1, 5, 7, 9, 70]


def test_area_hours_keep_no_state_and_go_on_after_a_failure(spark, frame, tmp_path, monkeypatch):
    places = {name: f"file://{tmp_path}/{name}" for name in ("in", "store", "state")}
    calls = []
    monkeypatch.setattr(seen, "HOUR_ROWS", 2)

    def run(after):
        seen.run_hours(streams.read_snapshots(spark, places["in"], KIND, files_per_batch=1), places["store"], places["state"], after)

    def note(rows, hours):
        calls.append((rows.count(), [h["snapshot_hour"] for h in hours]))

    def fail(rows, hours):
        raise RuntimeError("no room")

    def deliver(*rows):
        frame(KIND, *rows).coalesce(1).write.mode("append").parquet(places["in"])

    for k in range(3):  # three files, three batches
        deliver(row(k, 1), row(10 + k, 2))
    run(note)
    assert calls == [(6, [1, 2])] and not (tmp_path / "state" / "state").exists() and not (tmp_path / "state" / "arrived").exists()
    deliver(row(20, 2), row(0, 1))  # hour 1 gets a row again, but no new one
    with pytest.raises(RuntimeError, match="no room"):
        run(fail)
    deliver(row(20, 2), row(21, 3))
    run(note)
    run(note)
    assert calls == [(6, [1, 2]), (5, [2, 3])]
    assert spark.read.parquet(places["store"]).count() == 8
    with pytest.raises(ValueError, match="is new"):
        seen.run_hours(streams.read_snapshots(spark, places["in"], KIND), places["store"], f"file://{tmp_path}/other", note)


def test_area_hours_do_not_shuffle_observations_for_the_stop_map(spark, frame, tmp_path, monkeypatch):
    stops = frame("stop_id string, stop_name string, area_code string, area_name string, is_matched boolean", ("s1", "S", "a", "A", True))
    plans, measure = [], streams.area_hour_trips
    monkeypatch.setattr(streams, "area_hour_trips", lambda *a: plans.append(measure(*a)) or plans[-1])
    frame(KIND, row(1, 0, 700)).write.parquet(f"file://{tmp_path}/in")
    stream = streams.read_snapshots(spark, f"file://{tmp_path}/in", KIND)
    streams.run_area_hours(stream, stops.join(stops.select("stop_id"), "stop_id"), *[f"file://{tmp_path}/{name}" for name in ("store", "out", "state")])
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan
