"""Point in polygon against an independent brute-force test."""

import math
import random

from pyspark.sql import functions as F

from areaflow.operators import covering, spatial

RING = "array<struct<x: double, y: double>>"
AREAS = f"area_code string, area_name string, rings array<{RING}>"


def polygons(spark, *areas):
    return spark.createDataFrame([(c, f"Area {c}", rings) for c, rings in areas], AREAS)


SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]
STAR = [(10.0, 0.0), (12.0, 3.0), (14.0, 0.0), (13.0, 4.0), (15.0, 6.0), (12.0, 5.0), (9.0, 6.0), (11.0, 4.0)]


def crossings(ring, x, y):
    """Winding-free reference: count edges crossed by a ray to the left."""
    count = 0
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if min(ay, by) <= y < max(ay, by) and ax + (y - ay) * (bx - ax) / (by - ay) < x:
            count += 1
    return count


def stops(spark, *points):
    rows = [(f"s{i}", f"Stop {i}", float(y), float(x)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "stop_id string, stop_name string, stop_lat double, stop_lon double")


def found(df):
    return {(r["stop_id"], r["area_code"]) for r in df.collect()}


def test_random_points_agree_with_brute_force(spark):
    rng = random.Random(3)
    points = [(rng.uniform(-1, 16), rng.uniform(-1, 7)) for _ in range(400)]
    areas = polygons(spark, ("A", [SQUARE, HOLE]), ("B", [STAR]))
    expected = set()
    for i, (x, y) in enumerate(points):
        if (crossings(SQUARE, x, y) + crossings(HOLE, x, y)) % 2:
            expected.add((f"s{i}", "A"))
        if crossings(STAR, x, y) % 2:
            expected.add((f"s{i}", "B"))
    assert expected
    for cell in (0.5, 3.0):
        assert found(spatial.located_points(stops(spark, *points), areas, cell=cell)) == expected


def test_edges_corners_and_holes_are_outside(spark):
    areas = polygons(spark, ("A", [SQUARE, HOLE]))
    points = [(0, 2), (4, 4), (2, 0), (1.5, 1.5), (1, 1.5), (3, 3)]
    assert found(spatial.located_points(stops(spark, *points), areas)) == {("s5", "A")}


def test_a_closed_ring_gives_the_same_result(spark):
    areas = polygons(spark, ("A", [SQUARE + SQUARE[:1]]))
    assert found(spatial.located_points(stops(spark, (1, 1), (5, 1)), areas)) == {("s0", "A")}


def test_map_keeps_every_stop(spark):
    areas = polygons(spark, ("A", [SQUARE]), ("B", [[(3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0)]]))
    points = stops(spark, (1, 1), (3.5, 3.5), (50, 50), (1, 999))
    repeated = points.unionByName(points.where("stop_id = 's0'"))
    mapping = spatial.stop_area_map(repeated, areas)
    rows = sorted((r["stop_id"], r["area_code"], r["mapping_method"], r["is_matched"]) for r in mapping.fillna("-").collect())
    assert rows == [
        ("s0", "A", "within", True),
        ("s0", "A", "within", True),
        ("s1", "A", "within", True),
        ("s1", "B", "within", True),
        ("s2", "-", "within", False),
        ("s3", "-", "invalid_coordinates", False),
    ]


def test_report(spark):
    areas = polygons(spark, ("A", [SQUARE]))
    points = stops(spark, (1, 1), (2, 2), (50, 50), (1, 999))
    row = spatial.stop_area_report(points, spatial.stop_area_map(points, areas)).first().asDict()
    assert row == {
        "total_stops": 4,
        "valid_coordinate_stops": 3,
        "invalid_coordinate_stops": 1,
        "matched_stops": 2,
        "unmatched_stops": 2,
        "match_rate": 0.5,
        "low_match_warning": True,
    }


def test_located_points_keep_those_outside(spark):
    areas = polygons(spark, ("A", [SQUARE]))
    points = stops(spark, (1, 1), (5, 1))
    joined = spatial.located_points(points, areas, "left")
    assert found(joined) == {("s0", "A"), ("s1", None)}
    assert joined.where(F.col("area_code").isNull()).count() == 1


def test_cells_agree_with_brute_force_and_compare_fewer_edges(spark):
    rng = random.Random(8)
    teeth = [(i / 20, 3.0 + (i % 2) * 0.9 + rng.random() / 50) for i in range(200, -1, -1)]
    comb = [(0.0, 0.0), (10.0, 0.0), *teeth]
    hole = [(3.0, 1.0), (4.0, 1.0), (4.0, 2.0), (3.0, 2.0)]
    areas = polygons(spark, ("A", [comb, hole]), ("B", [STAR]), ("C", [SQUARE, HOLE]))
    points = [(rng.uniform(-1, 16), rng.uniform(-1, 7)) for _ in range(3000)] + [(float("nan"), 1.0), (1e12, 1.0)]
    expected = set()
    for i, (x, y) in enumerate(points):
        for code, rings in (("A", [comb, hole]), ("B", [STAR]), ("C", [SQUARE, HOLE])):
            if sum(crossings(r, x, y) for r in rings) % 2 and x < 1e9:
                expected.add((f"s{i}", code))
    cells = covering.area_covering(areas)
    assert cells.agg(F.max("level") - F.min("level")).first()[0] >= 3
    assert found(covering.located_by_cells(stops(spark, *points), cells)) == expected
    report = covering.covering_report(stops(spark, *points), cells).first()
    boxes = spatial.area_boxes(areas)
    bands = spatial.area_bands(boxes).withColumnRenamed("cell_y", "row").select("polygon", "row", F.size("edges").alias("n"))
    boxed = stops(spark, *points[:-2]).join(boxes, F.expr("stop_lon between min_x and max_x and stop_lat between min_y and max_y"))
    rows = boxed.withColumn("row", F.floor(F.col("stop_lat") / spatial.CELL_DEGREES).cast("int")).join(bands, ["polygon", "row"])
    finer = covering.covering_report(stops(spark, *points), covering.area_covering(areas, leaf_edges=2)).first()
    assert finer["settled"] > report["settled"] > 0 and finer["edges_compared"] < report["edges_compared"]
    by_bands = rows.agg(F.sum("n")).first()[0]
    assert report["edges_compared"] * 2 < by_bands and finer["edges_compared"] * 4 < by_bands, (report, finer, by_bands)


def test_cells_at_borders_corners_and_odd_areas(spark):
    areas = polygons(spark, ("A", [SQUARE, HOLE]), ("N", None), ("E", []), ("P", [[(7.0, 7.0)]]))
    points = [(0, 2), (4, 4), (2, 0), (1.5, 1.5), (1, 1.5), (3, 3), (7, 7)]
    for leaf in (0, 2, 16):
        cells = covering.area_covering(areas, leaf_edges=leaf, max_level=6)
        assert found(covering.located_by_cells(stops(spark, *points), cells)) == {("s5", "A")}
    assert found(covering.located_by_cells(stops(spark, *points), cells, "left")) >= {("s0", None), ("s5", "A")}
    empty = covering.area_covering(areas.limit(0))
    assert covering.located_by_cells(stops(spark, *points), empty).count() == 0


def test_cells_of_a_wide_fan_grow_slower_than_the_square_of_its_edges(spark):
    rng = random.Random(5)
    hole = [(0.0, 1.5), (1.5, 0.0), (0.0, -1.5), (-1.5, 0.0)]
    kept = {}
    for n in (500, 4000):
        rays = [((3 + 2 * rng.random()), 2 * math.pi * k / n) for k in range(n)]
        fan = [(round(r * math.cos(a), 6), round(r * math.sin(a), 6)) for r, a in rays]
        cells = covering.area_covering(polygons(spark, ("A", [fan, hole])))
        kept[n] = cells.agg(F.sum(F.size("edges"))).first()[0]
        points = [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(400)]
        expected = {(f"s{i}", "A") for i, (x, y) in enumerate(points) if (crossings(fan, x, y) + crossings(hole, x, y)) % 2}
        assert found(covering.located_by_cells(stops(spark, *points), cells)) == expected
    assert kept[4000] < 32 * kept[500], kept
