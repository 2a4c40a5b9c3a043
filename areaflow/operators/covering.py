"""Areas as quadtree cells: points in cells inside an area need no edge, others few.

A cell keeps the edges that touch it, and whether the other edges that a ray from it crosses are odd in number. Cells
that no edge touches are wholly inside or outside; others are split until few edges are left. The cells follow the
areas: large ones within, small ones along winding borders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.operators.spatial import area_boxes, edges_crossed, on_an_edge
from areaflow.runtime import lookup_join, materialize

#: Side of the cells of level 0 in degrees (each level halves it), the deepest level, and edges that a cell may keep.
TOP_DEGREES, MAX_LEVEL, LEAF_EDGES = 8.0, 14, 4
#: Edges of an area beyond which its cells keep more of them.
MANY = 256
#: Edges this close to a cell count as touching it, which rounding cannot change.
MARGIN = 1e-9
CELL = ("level", "cell_x", "cell_y")


def _side(level: Column) -> Column:
    return F.lit(TOP_DEGREES) / F.pow(F.lit(2.0), level)


def _cell(degrees: Column, level: Column) -> Column:
    return F.floor(degrees / _side(level)).cast("bigint")


def _touches(e: Column, x: Column, y: Column, half: Column) -> Column:
    """Whether an edge meets the square around x, y: their boxes overlap, and the corners lie on both sides of it."""
    reach = half + MARGIN
    wide, high = e["bx"] - e["ax"], e["by"] - e["ay"]
    overlap = (
        (F.least(e["ax"], e["bx"]) <= x + reach) & (F.greatest(e["ax"], e["bx"]) >= x - reach)
        & (F.least(e["ay"], e["by"]) <= y + reach) & (F.greatest(e["ay"], e["by"]) >= y - reach)
    )
    turn = F.abs(wide * (y - e["ay"]) - high * (x - e["ax"]))
    return overlap & (turn <= reach * (F.abs(wide) + F.abs(high)) * (1 + MARGIN) + MARGIN)


def _corners_right(cells: str, x: Column, low: Column, high: Column) -> Column:
    """Heights above `low` and at most `high` of the corners to the right of x at which what is counted in `odd` changes."""
    ends = F.concat(
        F.transform(cells, lambda e: F.struct(e["ax"].alias("x"), e["ay"].alias("y"))),
        F.transform(cells, lambda e: F.struct(e["bx"].alias("x"), e["by"].alias("y"))),
        F.col("loose"),
    )
    return F.transform(F.filter(ends, lambda c: (c["x"] > x) & (c["y"] > low) & (c["y"] <= high)), lambda c: c["y"])


def _settled(cells: DataFrame) -> DataFrame:
    """Cells with the edges that touch them. odd counts, at the foot of the cell, the other edges to the right of it.

    Rings are closed, so that count changes its parity on the way up only at corners to the right that an edge that
    touches the cell shares with one that does not: their heights are in `turns`. So no edge elsewhere in the row is
    kept. Cells outside their area drop out; those inside have no edges, no turns and odd = 1.
    """
    side, half = F.col("side"), F.col("side") / 2
    x0, y0 = F.col("cell_x") * side, F.col("cell_y") * side
    touching = lambda e: _touches(e, x0 + half, y0 + half, half)
    kept = cells.withColumn("side", _side(F.col("level")))
    right = F.size(edges_crossed(F.filter("edges", lambda e: ~touching(e)), x0 + half, y0))
    # the count of the larger cell, carried from its foot to the foot of this one
    carried = F.size(_corners_right("edges", F.col("right"), F.col("foot"), y0))
    kept = kept.withColumn("odd", (F.col("odd") + carried + right) % 2).withColumn("edges", F.filter("edges", touching))
    kept = kept.withColumn("turns", _corners_right("edges", x0 + side, y0, y0 + side)).withColumns({"right": x0 + side, "foot": y0})
    return kept.where("size(edges) > 0 or size(turns) > 0 or odd = 1").drop("side")


def area_covering(areas: DataFrame, leaf_edges: int = LEAF_EDGES, max_level: int = MAX_LEVEL) -> DataFrame:
    """The cells of all areas (area_code, area_name, rings): level, cell_x, cell_y, edges, odd and turns.

    Cells begin at the size of the area's box. Each level is one job over the cells that are still split, dealt to all
    cores and written to the shared folder, so a lost executor repeats one level at most; areas of few edges take one.
    The result grows with the length of the borders, not with the area. An area of more than MANY edges keeps more of
    them in a cell, by the root of their number: n long edges side by side would else make cells by the square of n.
    Edges without both corners do not count.
    """
    boxes = area_boxes(areas).drop("polygon")
    whole = lambda e: e["ax"].isNotNull() & e["ay"].isNotNull() & e["bx"].isNotNull() & e["by"].isNotNull()
    point = lambda e, k: F.struct(e[f"{k}x"].alias("x"), e[f"{k}y"].alias("y"))
    torn = F.filter("edges", lambda e: ~whole(e))
    loose = F.concat(F.transform(torn, lambda e: point(e, "a")), F.transform(torn, lambda e: point(e, "b")))
    boxes = boxes.withColumn("loose", F.filter(loose, lambda c: c["x"].isNotNull() & c["y"].isNotNull())).withColumn("edges", F.filter("edges", whole))
    boxes = boxes.withColumn("leaf", F.lit(leaf_edges) * F.greatest(F.lit(1.0), F.sqrt(F.size("edges") / MANY)))
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(TOP_DEGREES / 2**max_level))
    first = F.greatest(F.lit(0), F.floor(F.log2(F.lit(TOP_DEGREES) / extent))).cast("int")
    nowhere = F.lit(float("inf"))
    cells = boxes.withColumn("level", first).withColumns({"odd": F.lit(0), "right": nowhere, "foot": nowhere})
    for axis in ("x", "y"):
        cells = cells.withColumn(f"cell_{axis}", F.explode(F.sequence(_cell(F.col(f"min_{axis}"), F.col("level")), _cell(F.col(f"max_{axis}"), F.col("level")))))
    cells = cells.drop("min_x", "max_x", "min_y", "max_y")
    split = (F.size("edges") > F.col("leaf")) & (F.col("level") < max_level)
    tasks = areas.sparkSession.sparkContext.defaultParallelism * 2
    done = []
    while True:
        level = materialize(_settled(cells), "cells")
        done.append(level.where(~split).drop("leaf", "loose", "right", "foot"))
        rest = level.where(split)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)
        quarters = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
        cells = rest.repartition(tasks, "area_code", *CELL).withColumn("q", quarters).withColumns(
            {"level": F.col("level") + 1, "cell_x": F.col("cell_x") * 2 + F.col("q.a"), "cell_y": F.col("cell_y") * 2 + F.col("q.b")}
        ).drop("q")


def _near(points: DataFrame, covering: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct places (_x, _y) with the cells that hold them: one equi-join over the levels in use."""
    levels = sorted(r["level"] for r in covering.select("level").distinct().collect())  # MAX_LEVEL at most
    place = {"_x": F.col(x).try_cast("double"), "_y": F.col(y).try_cast("double")}
    on_map = (F.abs("_x") <= 720) & (F.abs("_y") <= 720)
    places = points.select(*[c.alias(n) for n, c in place.items()]).where(on_map).distinct()
    places = places.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    places = places.withColumns({"cell_x": _cell(F.col("_x"), F.col("level")), "cell_y": _cell(F.col("_y"), F.col("level"))})
    return places.join(covering, list(CELL))


def located_by_cells(points: DataFrame, covering: DataFrame, how: str = "inner", x: str = "stop_lon", y: str = "stop_lat") -> DataFrame:
    """Points joined to the areas they lie strictly within, as spatial.located_points, through the cells of the areas."""
    px, py, edges = F.col("_x"), F.col("_y"), F.col("edges")
    turned = F.size(F.filter("turns", lambda h: h <= py))
    odd = (F.col("odd") + turned + F.size(edges_crossed(edges, px, py))) % 2 == 1
    inside = _near(points, covering, x, y).where(odd & ~on_an_edge(edges, px, py))
    placed = points.withColumns({"_x": F.col(x).try_cast("double"), "_y": F.col(y).try_cast("double")})
    found = inside.select("_x", "_y", "area_code", "area_name")
    return lookup_join(placed, found, ["_x", "_y"], how).select(*points.columns, "area_code", "area_name")


def covering_report(points: DataFrame, covering: DataFrame, x: str = "stop_lon", y: str = "stop_lat") -> DataFrame:
    """One row: places met by a cell, those settled by the cell alone, and edges compared for the others."""
    return _near(points, covering, x, y).agg(
        F.count(F.lit(1)).alias("met"), F.count_if(F.size("edges") == 0).alias("settled"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges_compared")
    )
