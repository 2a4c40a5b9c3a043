"""Parsing, rules and ranking."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from areaflow.functions import parsing, rules
from areaflow.functions.ranking import percent_rank_nulls_last


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_numbers_from_text(frame):
    df = frame("t string", ("12",), (" 12.0 ",), ("12.7",), ("abc",), ("",), (None,), ("NaN",), ("1e2",), ("5d",))
    assert values(df, parsing.to_number(F.col("t"))) == [12.0, 12.0, 12.7, None, None, None, None, 100.0, None]
    assert values(df, parsing.to_whole(F.col("t"))) == [12, 12, None, None, None, None, None, 100, None]


def test_large_whole_numbers_keep_every_digit(frame):
    df = frame("t string", ("9007199254740993",))
    assert values(df, parsing.to_whole(F.col("t"))) == [9007199254740993]


def test_flags_are_never_null(frame):
    df = frame("t string", ("TRUE",), (" yes ",), ("1",), ("no",), ("",), (None,))
    assert values(df, parsing.to_flag(F.col("t"))) == [True, True, True, False, False, False]


def test_times_with_offset_become_utc(frame):
    df = frame("t string", ("2026-05-28T07:54:00+00:00",), ("2026-05-28T09:54:00+02:00",), ("never",))
    texts = values(df, parsing.to_time(F.col("t")).cast("string"))
    assert texts == ["2026-05-28 07:54:00", "2026-05-28 07:54:00", None]


def test_snapshot_time_from_path(frame):
    path = "/x/feed=trip_updates/year=2026/month=05/day=28/hour=07/minute=45/part-0.csv"
    df = frame("p string", (path,), ("/x/feed=trip_updates/year=2026/part-0.csv",))
    assert values(df, parsing.snapshot_time_of(F.col("p")).cast("string")) == ["2026-05-28 07:45:00", None]
    assert values(df, parsing.path_part(F.col("p"), "feed", "[^/]+")) == ["trip_updates"] * 2


def test_coordinates(frame):
    df = frame("lat string, lon string", ("-37.8", "144.9"), ("999", "144.9"), ("-37.8", "abc"), (None, "1"), ("90", "-180"))
    assert values(df, rules.valid_coordinates(F.col("lat"), F.col("lon"))) == [True, False, False, False, True]


def test_delay_rules_at_their_limits(frame):
    df = frame("a int, d int", (300, None), (301, None), (None, 601), (1200, 1201), (None, None), (-50, 10))
    largest = rules.max_delay(F.col("a"), F.col("d"))
    assert values(df, largest) == [300, 301, 601, 1201, None, 10]
    assert values(df, rules.is_late(largest)) == [False, True, True, True, False, False]
    assert values(df, rules.delay_band(largest)) == [
        "early_or_on_time",
        "minor_delay",
        "moderate_delay",
        "major_delay",
        "early_or_on_time",
        "early_or_on_time",
    ]


def test_alert_effects_match_names_in_any_case_but_not_numbers(frame):
    df = frame("e string", ("no_service",), ("1",), (None,), ("OTHER_EFFECT",), ("DETOUR",), ("SIGNIFICANT_DELAYS",))
    assert values(df, rules.is_disruption(F.col("e"))) == [True, False, False, True, True, True]
    assert values(df, rules.alert_band(F.col("e"))) == [
        "critical", "informational", "informational", "unknown", "moderate", "high",
    ]


def test_bands(frame):
    df = frame("s double", (80.0,), (79.9,), (40.0,), (20.0,), (19.9,), (None,))
    assert values(df, rules.risk_band(F.col("s"))) == ["very_high", "high", "moderate", "low", "minimal", "minimal"]
    hours = frame("h int", (6,), (7,), (9,), (10,), (16,), (18,), (19,))
    assert values(hours, rules.peak_period(F.col("h"))) == [
        "off_peak", "morning_peak", "morning_peak", "midday", "evening_peak", "evening_peak", "off_peak",
    ]
    days = frame("d int", (0,), (1,), (6,), (7,), (13,), (14,))
    assert values(days, rules.sufficiency(F.col("d"))) == [
        "insufficient", "exploratory", "exploratory", "analyst-ready", "analyst-ready", "strong",
    ]


def test_area_codes_and_names(frame):
    df = frame("c string", (" 206011097 ",), ("© Commonwealth of Australia 2023",), ("12345",), (None,))
    assert values(df, rules.valid_area_code(F.col("c"))) == [True, False, False, False]
    names = frame("n string", ("Melbourne",), ("© x",), ("The Australian Bureau of Statistics",), ("  ",), (None,))
    assert values(names, rules.valid_area_name(F.col("n"))) == [True, False, False, False, False]


@pytest.mark.parametrize("range_values", [1, 3, 50, 4096])
def test_ranged_rank_equals_window(spark, range_values):
    rng = random.Random(7)
    # A third of the rows share one value, some are null, the rest is spread unevenly.
    rows = [(i, 5.0 if i % 3 == 0 else None if i % 11 == 0 else round(rng.paretovariate(1), 2)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, v double")
    expected = df.withColumn("r", F.percent_rank().over(Window.orderBy(F.asc_nulls_last("v"))))
    wanted = {r["id"]: r["r"] for r in expected.collect()}
    got = {r["id"]: r["r"] for r in percent_rank_nulls_last(df, "v", "r", range_values).collect()}
    assert got == pytest.approx(wanted)


def test_rank_of_single_and_all_null_rows(frame):
    assert values(percent_rank_nulls_last(frame("v double", (1.0,)), "v", "r"), "r") == [0.0]
    assert values(percent_rank_nulls_last(frame("v double", (None,), (None,)), "v", "r"), "r") == [0.0, 0.0]
