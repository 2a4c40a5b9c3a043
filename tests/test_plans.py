"""Events, aggregates, context, scores, marts and reports on small frames, with their special cases."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from areaflow.operators import aggregate as agg
from areaflow.plans import context, events, exposure, marts, reports, score
from areaflow.plans.pipeline import Pipeline

UPDATES = (
    "snapshot_timestamp timestamp, entity_id string, trip_id string, route_id string, stop_id string, "
    "arrival_delay_seconds int, departure_delay_seconds int"
)
MAP = "stop_id string, stop_name string, area_code string, area_name string, is_matched boolean"
T7 = datetime(2026, 5, 28, 7, 54)
AREA = "20601"


@pytest.fixture(scope="module")
def stop_map(spark):
    return spark.createDataFrame(
        [("s1", "One", AREA, "Area A", True), ("s2", None, AREA, "Area A", True), ("s3", "Three", None, None, False)], MAP
    )


@pytest.fixture(scope="module")
def updates(spark):
    rows = [
        (T7, "e1", "t1", "r1", "s1", 400, 200),
        (T7, "e2", "t2", "r1", "s2", 10, 20),
        (T7, "e3", "t2", None, "missing", 0, 0),
        (T7, "e4", "t3", "r2", "s1", None, None),
        (T7, "e5", "t3", "r2", None, 5000, None),
    ]
    return spark.createDataFrame(rows, UPDATES)


def one(df, **where):
    for column, value in where.items():
        df = df.where(F.col(column).eqNullSafe(F.lit(value)))
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_observation_base_counts_and_keeps_the_null_area(updates, stop_map):
    base = agg.observation_base(updates, stop_map)
    row = one(base, area_code=AREA)
    assert (row["observation_count"], row["delayed_observation_count"], row["distinct_stop_count"]) == (3, 1, 2)
    assert row["snapshot_date"] == "2026-05-28" and row["snapshot_hour"] == 7
    assert one(base, area_code=None)["unmatched_stop_observation_count"] == 1
    report = one(agg.observation_report(updates, stop_map))
    assert report == {"total_observations": 4, "matched_observations": 3, "unmatched_observations": 1}


def test_delay_events(updates, stop_map, spark):
    stops = spark.createDataFrame([("s2", "Two"), ("missing", "Lost")], "stop_id string, stop_name string")
    delays = events.delay_events(updates, stop_map, stops)
    assert delays.count() == 5
    rows = {(r["trip_id"], r["stop_id"]): r for r in delays.collect()}
    assert rows["t1", "s1"]["max_delay_seconds"] == 400 and rows["t1", "s1"]["delay_severity_band"] == "minor_delay"
    assert rows["t1", "s1"]["is_arrival_delayed"] and not rows["t1", "s1"]["is_departure_delayed"]
    assert rows["t2", "s2"]["stop_name"] == "Two" and rows["t2", "missing"]["stop_name"] == "Lost"
    assert rows["t2", "missing"]["area_code"] is None
    assert not rows["t3", "s1"]["is_delayed"] and rows["t3", "s1"]["delay_severity_band"] == "early_or_on_time"
    assert rows["t3", None]["delay_severity_band"] == "major_delay"


def test_repeated_stops_fan_out_like_two_left_joins(updates, spark):
    twice = spark.createDataFrame([("s1", "One", "A", "a", True), ("s1", "One", "B", "b", True)], MAP)
    stops = spark.createDataFrame([("s1", "x"), ("s1", "y"), ("s2", "z")], "stop_id string, stop_name string")
    ours = events.delay_events(updates, twice, stops).select("trip_id", "stop_id", "stop_name", "area_code")
    joined = updates.join(twice.withColumnRenamed("stop_name", "m"), "stop_id", "left").join(stops, "stop_id", "left")
    plain = joined.select("trip_id", "stop_id", F.coalesce("m", "stop_name").alias("stop_name"), "area_code")
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_area_name_is_the_largest_one(updates, spark):
    several = spark.createDataFrame([("s1", "One", AREA, "B", True), ("s2", "Two", AREA, "A", True)], MAP)
    delays = events.delay_events(updates, several)
    assert one(agg.area_hour_trips(delays))["area_name"] == "B"


ALERTS = "snapshot_timestamp timestamp, entity_id string, effect string, informed_route_id string, informed_stop_id string"


@pytest.fixture(scope="module")
def alerts(spark, stop_map):
    rows = [(T7, "a1", "detour", "r1", "s1"), (T7, "a2", "4", "r9", "s1"), (datetime(2026, 5, 28, 8), "a3", "NO_SERVICE", None, "s2")]
    return events.alert_events(spark.createDataFrame(rows, ALERTS), stop_map)


def test_exposure_joins_both_sides(updates, stop_map, alerts, spark):
    delays = events.delay_events(updates, stop_map)
    counts = spark.createDataFrame([("other", 1, 1)], "area_code string, stop_count long, route_count long")
    rows = exposure.area_hour_exposure(delays, alerts, counts)
    both = one(rows, snapshot_hour=7)
    assert (both["observation_count"], both["service_alert_count"], both["disruption_alert_count"]) == (3, 2, 1)
    assert both["delay_observation_rate"] == pytest.approx(1 / 3)
    assert both["routes_serving_area"] == 0 and both["stops_in_area"] == 0
    alert_only = one(rows, snapshot_hour=8)
    assert alert_only["observation_count"] == 0 and alert_only["delay_observation_rate"] is None
    assert alert_only["area_name"] is None and alert_only["max_delay_seconds"] is None


def test_route_days_keep_unknown_routes(updates, stop_map, alerts, spark):
    routes = spark.createDataFrame(
        [("r1", "1", "Line 1", 2)], "route_id string, route_short_name string, route_long_name string, route_type int"
    )
    days = exposure.route_day_disruption(events.delay_events(updates, stop_map), alerts, routes)
    assert one(days, route_id="r1")["route_short_name"] == "1"
    unknown = one(days, route_id="r9")
    assert unknown["route_short_name"] is None and unknown["observed_trip_update_rows"] == 0
    assert unknown["service_date"] == date(2026, 5, 28)
    assert days.where("route_id is null").isEmpty()


def test_route_area_coverage(spark, stop_map):
    routes = spark.createDataFrame(
        [("r1", "M1", "Metro 1", 2)], "route_id string, route_short_name string, route_long_name string, route_type int"
    )
    trips = spark.createDataFrame([("t1", "r1")], "trip_id string, route_id string")
    times = spark.createDataFrame(
        [("t1", "s1", "1"), ("t1", "s2", "2"), ("t9", "s1", "x"), ("t1", "s3", "3")],
        "trip_id string, stop_id string, stop_sequence string",
    )
    coverage = agg.route_area_coverage(times, trips, stop_map, routes)
    assert len(coverage.columns) == 10
    row = one(coverage, route_id="r1")
    assert (row["stop_count_in_area"], row["first_stop_sequence"], row["last_stop_sequence"]) == (2, 1, 2)
    orphan = one(coverage, route_id=None)
    assert orphan["trip_count_serving_area"] == 1 and orphan["first_stop_sequence"] is None
    assert one(agg.coverage_report(coverage)) == {"coverage_rows": 2, "distinct_routes": 1, "distinct_areas": 1}


INDEX = "area_code string, area_name string, score double, decile double, percentile double"


def test_weights_use_each_source_in_turn(spark):
    index = spark.createDataFrame(
        [("a", "A", 900.0, 1.0, 50.0), ("b", "B", 800.0, None, 25.0), ("c", "C", 850.0, None, None), ("d", "D", None, None, None)],
        INDEX,
    )
    weights = {r["area_code"]: r["disadvantage_weight"] for r in context.disadvantage_weight(index).collect()}
    # Rank of c: one of three other areas is below it; the area without a score ranks last.
    assert weights == pytest.approx({"a": 1.0, "b": 0.75, "c": 1 - 1 / 3, "d": 0.5})


def test_access_proxy(spark):
    index = spark.createDataFrame([(c, c, 1.0, 5.0, None) for c in "abc"], INDEX)
    counts = spark.createDataFrame([("a", 1, 1), ("b", 4, 2)], "area_code string, stop_count long, route_count long")
    proxies = {r["area_code"]: r["transport_access_proxy_score"] for r in context.area_context(index, counts).collect()}
    assert proxies == pytest.approx({"a": 100 / 3, "b": 100.0, "c": 0.0})
    flat = context.area_context(index, counts.limit(0))
    assert {r[0] for r in flat.select("transport_access_proxy_score").collect()} == {50.0}


EXPOSURE = (
    "snapshot_date date, snapshot_hour int, area_code string, area_name string, observation_count long, "
    "distinct_trip_count long, distinct_stop_count long, delayed_observation_count long, delay_observation_rate double, "
    "avg_arrival_delay_seconds double, avg_departure_delay_seconds double, max_delay_seconds int, major_delay_count long, "
    "service_alert_count long, disruption_alert_count long"
)


def exposure_row(hour, area, rate, average, largest, alerts, observed=10):
    delayed = int((rate or 0) * observed)
    return (date(2026, 5, 28), hour, area, area, observed, 1, 1, delayed, rate, average, 0.0, largest, 0, alerts, alerts)


@pytest.fixture(scope="module")
def area_context(spark):
    index = spark.createDataFrame([("a", "A", 900.0, 1.0, None), ("b", "B", 900.0, 10.0, None)], INDEX)
    counts = spark.createDataFrame([("a", 1, 1), ("b", 3, 1)], "area_code string, stop_count long, route_count long")
    return context.area_context(index, counts)


def test_scores_of_the_extremes(spark, area_context):
    rows = [exposure_row(7, "a", 1.0, 600.0, 900, 4), exposure_row(7, "b", 0.0, 0.0, 0, 0), exposure_row(8, "x", 0.5, 300.0, 450, 2)]
    scores = score.area_hour_score(spark.createDataFrame(rows, EXPOSURE), area_context)
    worst = one(scores, area_code="a")
    assert worst["disruption_score"] == pytest.approx(100) and worst["equity_impact_score"] == pytest.approx(100)
    assert worst["equity_risk_band"] == "very_high" and worst["network_exposure_score"] == pytest.approx(0)
    best = one(scores, area_code="b")
    assert best["equity_impact_score"] == pytest.approx(0) and best["disadvantage_score"] == pytest.approx(10)
    unknown = one(scores, area_code="x")
    assert unknown["equity_impact_score"] == pytest.approx(50 * (0.6 + 0.4 * 0.5))
    assert unknown["network_exposure_score"] == 50.0 and unknown["decile"] is None


def test_one_flat_severity_measure_gives_null_scores(spark, area_context):
    rows = [exposure_row(7, "a", 1.0, 600.0, 900, 4), exposure_row(7, "b", 0.0, 0.0, 900, 0)]
    scores = score.area_hour_score(spark.createDataFrame(rows, EXPOSURE), area_context)
    assert {(r["equity_impact_score"], r["equity_risk_band"]) for r in scores.collect()} == {(None, "minimal")}
    both_flat = [exposure_row(7, "a", 1.0, 5.0, 900, 4), exposure_row(7, "b", 0.0, 5.0, 900, 0)]
    scores = score.score_components(spark.createDataFrame(both_flat, EXPOSURE), area_context)
    assert {r["delay_severity_score"] for r in scores.collect()} == {0.0}


def test_given_bounds_score_new_rows_on_the_old_scale(spark, area_context):
    old = spark.createDataFrame([exposure_row(7, "a", 1.0, 600.0, 900, 4), exposure_row(7, "b", 0.0, 0.0, 0, 0)], EXPOSURE)
    new = spark.createDataFrame([exposure_row(9, "a", 0.5, 300.0, 450, 2)], EXPOSURE)
    scores = score.area_hour_score(new, area_context, score.score_bounds(old))
    assert one(scores)["disruption_score"] == pytest.approx(50)


def test_rejoined_scores_equal_carried_scores(spark, area_context):
    rows = [exposure_row(h, a, h / 20, h * 10.0, h * 20, h) for h in range(5) for a in "abx"]
    table = spark.createDataFrame(rows, EXPOSURE)
    carried = score.area_hour_score(table, area_context).drop("calculated_at")
    components = score.score_components(table, area_context)
    joined = score.join_score_exposure(components, table, area_context).drop("calculated_at")
    assert joined.columns == carried.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, carried.collect()))


SCORES = (
    "snapshot_date date, snapshot_hour int, area_code string, area_name string, decile double, disadvantage_weight double, "
    "observation_count long, delayed_observation_count long, delay_observation_rate double, disruption_alert_count long, "
    "disruption_score double, equity_impact_score double, equity_risk_band string, score_formula_version string, "
    "calculated_at timestamp"
)


def score_row(day, hour, area, impact, band, decile=1.0, observed=10):
    return (date(2026, 5, day), hour, area, area, decile, 0.5, observed, 1, 0.1, 0, impact, impact, band, "v", T7)


@pytest.fixture(scope="module")
def scores(spark):
    rows = [
        score_row(1, 7, "a", 85.0, "very_high"),
        score_row(1, 8, "a", 65.0, "high"),
        score_row(2, 7, "a", 10.0, "minimal"),
        score_row(1, 16, "b", 65.0, "high", 5.0),
        score_row(1, 17, "b", 25.0, "low", 5.0),
        score_row(1, 12, "c", None, "minimal", None, 0),
    ]
    return spark.createDataFrame(rows, SCORES)


def test_daily_peak_band_is_text_order_and_a_true_peak_is_added(scores):
    row = one(marts.area_day_summary(scores), area_code="b")
    assert (row["peak_equity_risk_band"], row["peak_band_by_score"]) == ("low", "high")
    empty = one(marts.area_day_summary(scores), area_code="c")
    assert empty["delay_observation_rate"] is None and empty["peak_band_by_score"] == "minimal"


def test_multi_day_summary(scores):
    row = one(marts.area_multi_day_summary(scores), area_code="a")
    assert (row["days_observed"], row["snapshot_hours_observed"], row["high_or_above_snapshot_count"]) == (2, 2, 2)
    assert row["high_or_above_snapshot_rate"] == pytest.approx(2 / 3) and row["peak_equity_risk_band"] == "very_high"


def test_reports(scores):
    top = reports.top_areas(scores, k=2).collect()
    assert [(r["area_code"], r["equity_impact_score"]) for r in top] == [("a", 85.0), ("a", 65.0)]
    assert reports.top_areas(scores).collect()[-1]["area_code"] == "c"
    bands = {r["decile_band"]: r["area_hour_rows"] for r in reports.decile_bands(scores).collect()}
    assert bands == {"most_disadvantaged_deciles_1_3": 3, "middle_deciles_4_7": 2}
    exact = reports.decile_bands(scores, rounded=False)
    assert "avg_delay_observation_rate" in exact.columns and exact.count() == 2
    assert reports.hours(scores, rounded=False).count() == 5
    assert {r["snapshot_hour"]: r["peak_period_flag"] for r in marts.hourly_pattern(scores).collect()}[16] == "evening_peak"
    row = one(reports.data_sufficiency(scores))
    assert (row["days_in_mart"], row["area_hour_rows"], row["data_sufficiency"]) == (2, 6, "exploratory")
    summary = marts.area_multi_day_summary(scores)
    assert {r["area_code"] for r in reports.high_impact_areas(summary).collect()} == {"a", "b"}
    assert [r["area_code"] for r in reports.recurring_areas(summary).collect()] == ["a", "b", "c"]


def test_published_invariants(updates, stop_map, alerts, spark):
    """Route rows add up to all observations with a route; delayed totals agree between groupings."""
    delays = events.delay_events(updates, stop_map)
    by_route = agg.route_day_trips(delays).agg(F.sum("observed_trip_update_rows")).first()[0]
    assert by_route == updates.where("route_id is not null").count()
    by_area = agg.area_hour_trips(delays).agg(F.sum("delayed_observation_count")).first()[0]
    assert by_area == delays.where("is_delayed and area_code is not null").count()


def test_observations_and_stop_times_are_not_shuffled_for_the_stop_map(updates, spark, frame):
    n = 200_000  # so large that its size has to be known to be joined without a shuffle
    numbers = spark.range(n).selectExpr("concat('S', id) as stop_id", "id % 50 as k")
    names = spark.range(50).selectExpr("id as k", "concat('A', id) as area_code", "concat('Area ', id) as area_name", "true as is_matched")
    stop_map = numbers.join(names, "k").drop("k")
    stop_times = frame("trip_id string, stop_id string, stop_sequence int", ("t1", "S1", 1), ("t1", "S51", 2))
    trips = frame("trip_id string, route_id string", ("t1", "r1"))
    routes = frame("route_id string, route_short_name string, route_long_name string, route_type int", ("r1", "1", "One", 3))
    p = Pipeline(updates, None, stop_map, None, routes, trips, stop_times, None)
    for table in (p.coverage, p.observations):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "stop-areas" in plan and not re.search(r"hashpartitioning\(stop_id", plan), plan
    assert [(r["area_code"], r["stop_count_in_area"]) for r in p.coverage.collect()] == [("A1", 2)]
    assert p.stop_areas.count() == n


def test_joined_exposure_reads_no_observation_twice(spark, monkeypatch):
    from areaflow.checks import models

    asked = []

    class Given:
        def pipeline(self, **options):
            asked.append(options)
            raise StopIteration

    with pytest.raises(StopIteration):
        models.join_score_exposure(Given())
    assert asked == [{"store": True}]
