"""Distinct counts that merge, the stored chain, and what its plans read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from areaflow.fixtures import Tables
from areaflow.operators import aggregate as agg
from areaflow.operators import distinct as di
from areaflow.plans import reports
from areaflow.runtime import footer_bounds

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(seed, n=400):
    draw = random.Random(seed)
    pick = lambda *values: draw.choice([*values, None])
    return [(pick("a", "b"), pick("x", "y"), draw.randint(0, 200) if draw.random() < 0.7 else None, pick(*"tuvw"), draw.randint(0, 9)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_merge_exactly(frame, seed):
    given = rows(seed)
    df = frame("g string, h string, number int, text string, v int", *given).repartition(3)
    ids = [di.Ids(F.col("number"), F.col("text"), {"big": F.col("v") > 5}), di.Ids(text=F.col("text"))]
    found = di.words(df, ("g", "h"), ids, {"total": ("sum", F.col("v")), "top": ("max", F.col("v"))})
    assert "Expand" not in plan(found)
    counts = [di.distinct(0).alias("ids"), di.distinct(0, "big").alias("big"), di.distinct(1).alias("texts"), F.sum("total").alias("total"), F.max("top").alias("top")]
    for keys, at in ((("g", "h"), found), (("g",), di.merged(found, ("g",), {"total": "sum", "top": "max"}))):
        for r in at.groupBy(*keys).agg(*counts).collect():
            own = [x for x in given if all(x["gh".index(k)] == r[k] for k in keys)]
            one = lambda xs: len({(x[2], None) if x[2] is not None else (None, x[3]) for x in xs} - {(None, None)})
            assert r["ids"] == one(own) and r["big"] == one([x for x in own if x[4] > 5])
            assert r["texts"] == len({x[3] for x in own} - {None})
            assert r["total"] == sum(x[4] for x in own) and r["top"] == max(x[4] for x in own)


def test_days_and_hours(frame):
    days = [dt.date(1969, 12, 30) + dt.timedelta(days=k) for k in (0, 1, 2, 3, 64, 65, 30_000)] + [None]
    given = [("a", d, h) for d in days for h in (0, 5, 23)] + [("b", None, None), ("c", days[0], 7)] * 2
    found = di.days_and_hours(frame("k string, d date, h int", *given), "k", "d", "h", {"n": ("sum", F.lit(1).cast("long"))})
    assert {r["k"]: (r["days"], r["hours"], r["n"]) for r in found.collect()} == {"a": (7, 3, 24), "b": (0, 0, 2), "c": (1, 1, 2)}
    assert "Expand" not in plan(found)


def test_numbered(frame):
    df = di.numbered(frame("id string, x int", ("a", 1), ("b", 2), ("a", 3), (None, 4)), "id", "no")
    found = {(r["id"], r["no"]) for r in df.collect()}
    assert len(found) == 3 and (None, None) in found


def test_hours_merge_to_days_and_routes(spark):
    """Stored hours give what the observations give."""
    t = Tables(spark, SF_DIR)
    once, direct = t.pipeline(store=True, merge_hours=True), t.pipeline()
    order = lambda df: sorted(map(str, df.drop("calculated_at").select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in df.drop("calculated_at").dtypes]).collect()))
    assert order(once.scores) == order(direct.scores)
    assert order(once.route_days) == order(direct.route_days)
    assert order(reports.route_contribution_of_hours(once.delay_hours, once.multi_day)) == order(reports.route_contribution(direct.delays, direct.multi_day))
    for df in (once.scores, once.route_days, once.multi_day):
        assert "lineitem" not in plan(df) and "Expand" not in plan(df)


def test_score_chain_reads_observations_once(spark):
    p = Tables(spark, SF_DIR).pipeline(store=True)
    assert plan(p.area_hour_measures).count("lineitem.parquet") == 1 and "Expand" not in plan(p.area_hour_measures)
    assert "lineitem" not in plan(p.scores)
    assert "lineitem" not in plan(p.components)


def test_plain_and_numbered_delays_agree(spark):
    p = Tables(spark, SF_DIR).pipeline()
    plain, numbered = agg.area_hour_trips(p.delays), agg.area_hour_trips(p.numbered_delays, p.area_names)
    assert plain.columns == numbered.columns
    assert plain.exceptAll(numbered).isEmpty() and numbered.exceptAll(plain).isEmpty()


def test_bounds_come_from_footers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(100).select(F.col("id").cast("double").alias("a"), (-F.col("id")).alias("b")).repartition(4).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert tuple(footer_bounds(spark, path, {"x": "a", "y": "b"}).first()) == (0.0, 99.0, -99, 0)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    with_scan = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    assert with_scan == "false"


DELAYS = """snapshot_date date, snapshot_hour int, area_code string, area_name string, route_id string, trip_id string, stop_id string, arrival_delay_seconds int,
    departure_delay_seconds int, max_delay_seconds int, is_delayed boolean, delay_severity_band string"""


def delay_rows(n=300):
    draw = random.Random(7)
    pick = lambda *values: draw.choice([*values, None])
    days = (dt.date(2026, 5, 1), dt.date(2026, 5, 2))
    return [
        (pick(*days), pick(6, 7), pick("a", "b"), pick("A", "B"), pick("r", "s"), pick(*"tuv"), pick("S1", "S2"), pick(0, 400), pick(10, 500), pick(400, 900), pick(True, False), pick("major_delay", "minor_delay"))
        for _ in range(n)
    ]


def test_counts_apart_are_the_same_and_left_out_where_not_shown(frame):
    """Null dates, hours and ids included; without a count shown, the plan has no words of ids."""
    delays = frame(DELAYS, *delay_rows()).repartition(3)
    stored = [f(delays).localCheckpoint() for f in (agg.delay_words, agg.split_words)]
    for plain, *others in (
        (agg.area_hour_trips(delays), agg.area_hour_trips(delays, apart=True), *map(agg.area_hours, stored)),
        (agg.route_day_trips(delays), agg.route_day_trips(delays, apart=True), *map(agg.route_days, stored)),
    ):
        for other in others:
            assert plain.columns == other.columns and "bit_or" in plan(other)
            assert sorted(map(str, plain.collect())) == sorted(map(str, other.collect()))
            assert "bit_or" not in plan(other.drop("distinct_trip_count", "distinct_stop_count"))


def test_table_tests_read_no_ids(spark):
    from areaflow.checks.tables import tested_tables
    from areaflow.plans.table_tests import run_table_tests

    t = Tables(spark, SF_DIR)
    for kind in ("not_null", "range"):
        assert "bit_or" not in plan(run_table_tests(tested_tables(t, kind), kind))
    whole, apart = t.pipeline(), t.pipeline(apart=True)
    for name in ("coverage", "observations"):
        a, b = getattr(whole, name), getattr(apart, name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rules_of_the_observation_base_read_no_ids(spark):
    from areaflow.checks.tables import contract_tables

    base = contract_tables(Tables(spark, SF_DIR), ("observation_base",))["observation_base"][1]
    assert "distinct_trip_count" in base.columns and "bit_or" in plan(base)
    assert "bit_or" not in plan(base.drop("distinct_trip_count", "distinct_stop_count"))


def test_delays_are_not_shuffled_for_the_high_areas(spark):
    p = Tables(spark, SF_DIR).pipeline(merge_hours=True)
    for df in (reports.route_contribution_of_hours(p.delay_hours, p.multi_day), reports.route_contribution(p.delays, p.multi_day)):
        assert "high-areas" in plan(df) and "hashpartitioning(area_code" not in plan(df)
