"""Point-in-polygon join of stops and areas, and reports about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions.rules import valid_coordinates
from areaflow.operators.standardize import require_area_columns
from areaflow.runtime import lookup_join, with_bounds

CELL_DEGREES = 0.5
LOW_MATCH_RATE = 0.9
MAP_COLUMNS = ("stop_id", "stop_name", "stop_lat", "stop_lon", "area_code", "area_name", "mapping_method", "is_matched")


def polygon_edges(rings: Column) -> Column:
    """All edges of array<array<struct<x, y>>>, every ring closed, as array<struct<ax, ay, bx, by>>."""

    def ring_edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
        )

    return F.flatten(F.transform(rings, ring_edges))


def on_an_edge(edges: Column, x: Column, y: Column) -> Column:
    def on_edge(e: Column) -> Column:
        turn = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
        inside_box = x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(
            F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])
        )
        return (turn == 0) & inside_box

    return F.exists(edges, on_edge)


def edges_crossed(edges: Column, x: Column, y: Column) -> Column:
    """The edges that a ray to the right crosses."""

    def crosses(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        # The division is evaluated only for edges that span the point's height, so by - ay is not zero.
        height = F.when(spans, (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])
        return spans & (x < height)

    return F.filter(edges, crosses)


def strictly_within(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all edges (holes are rings of their own); a point on an edge is outside."""
    return (F.size(edges_crossed(edges, x, y)) % 2 == 1) & ~on_an_edge(edges, x, y)


def _cell(degrees: Column, cell: float) -> Column:
    return F.floor(degrees / F.lit(cell)).cast("int")


def area_boxes(areas: DataFrame) -> DataFrame:
    """Areas with edges, bounding box and an id of the polygon (area codes may have several)."""
    bounds = (("min_x", F.array_min, "ax"), ("max_x", F.array_max, "ax"), ("min_y", F.array_min, "ay"), ("max_y", F.array_max, "ay"))
    boxed = areas.select("area_code", "area_name", F.xxhash64("area_code", "area_name", "rings").alias("polygon"), polygon_edges(F.col("rings")).alias("edges"))
    return boxed.select("*", *[f(F.col(f"edges.{c}")).alias(name) for name, f, c in bounds])


def cells_of(low: str, high: str, cell: float) -> Column:
    return F.explode(F.sequence(_cell(F.col(low), cell), _cell(F.col(high), cell)))


def area_cells(boxes: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """Polygons without their edges for every grid cell that the bounding box touches."""
    return boxes.drop("edges").withColumn("cell_x", cells_of("min_x", "max_x", cell)).withColumn("cell_y", cells_of("min_y", "max_y", cell))


def area_bands(boxes: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """Polygons by grid row, each with only the edges that reach into the row: those that a test of a point there
    looks at. An edge is repeated for the rows that it crosses, not for the cells of the box."""
    rows = boxes.select("polygon", "edges", cells_of("min_y", "max_y", cell).alias("cell_y"))
    reaches = lambda e: (_cell(F.least(e["ay"], e["by"]), cell) <= F.col("cell_y")) & (_cell(F.greatest(e["ay"], e["by"]), cell) >= F.col("cell_y"))
    return rows.select("polygon", "cell_y", F.filter("edges", reaches).alias("edges"))


def located_points(points: DataFrame, areas: DataFrame, how: str = "inner", cell: float = CELL_DEGREES) -> DataFrame:
    """Points (with stop_lat, stop_lon) joined to the areas they lie strictly within.

    Each place is looked up once: places meet bounding boxes on their grid cell (an equi-join without geometry),
    then the edges of the box's grid row decide. A left join keeps points outside all areas.
    """
    x, y = F.col("_x"), F.col("_y")
    placed = points.withColumns({"_x": F.col("stop_lon").try_cast("double"), "_y": F.col("stop_lat").try_cast("double")})
    places = placed.where(x.isNotNull() & y.isNotNull()).select("_x", "_y").distinct()
    places = places.withColumns({"cell_x": _cell(x, cell), "cell_y": _cell(y, cell)})
    boxes = area_boxes(areas)
    near = places.join(area_cells(boxes, cell), ["cell_x", "cell_y"])
    near = near.where(x.between(F.col("min_x"), F.col("max_x")) & y.between(F.col("min_y"), F.col("max_y")))
    near = near.select("_x", "_y", "cell_y", "polygon", "area_code", "area_name")
    inside = near.join(area_bands(boxes, cell), ["polygon", "cell_y"]).where(strictly_within(F.col("edges"), x, y))
    found = inside.select("_x", "_y", "area_code", "area_name")
    return lookup_join(placed, found, ["_x", "_y"], how).select(*points.columns, "area_code", "area_name")


def valid_stops(stops: DataFrame) -> DataFrame:
    return stops.where(valid_coordinates(F.col("stop_lat"), F.col("stop_lon")))


def invalid_stops(stops: DataFrame) -> DataFrame:
    return stops.where(~valid_coordinates(F.col("stop_lat"), F.col("stop_lon")))


def stop_area_map(stops: DataFrame, areas: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """Every stop with the area it lies in. Stops with bad coordinates and stops outside all areas stay
    unmatched; a stop in two overlapping areas gives two rows."""
    columns = ("stop_id", "stop_name", "stop_lat", "stop_lon")
    located = located_points(valid_stops(stops).select(*columns), areas, "left", cell)
    within = located.withColumn("mapping_method", F.lit("within"))
    rejected = (
        invalid_stops(stops)
        .select(*columns)
        .withColumns(
            {
                "area_code": F.lit(None).cast("string"),
                "area_name": F.lit(None).cast("string"),
                "mapping_method": F.lit("invalid_coordinates"),
            }
        )
    )
    mapped = within.unionByName(rejected)
    return mapped.withColumn("is_matched", F.col("area_code").isNotNull()).select(*MAP_COLUMNS)


def stop_area_report(stops: DataFrame, mapping: DataFrame) -> DataFrame:
    """Total, valid, invalid, matched and unmatched stops, match rate and a warning below 90 %."""
    valid = F.count_if(valid_coordinates(F.col("stop_lat"), F.col("stop_lon")))
    totals = stops.agg(F.count(F.lit(1)).alias("total_stops"), valid.alias("valid_coordinate_stops"))
    matched = mapping.agg(F.count_if("is_matched").alias("matched_stops"))
    share = F.coalesce(F.col("matched_stops") / F.nullif(F.col("total_stops"), F.lit(0)), F.lit(0.0))
    return with_bounds(totals, matched).select(
        "total_stops",
        "valid_coordinate_stops",
        (F.col("total_stops") - F.col("valid_coordinate_stops")).alias("invalid_coordinate_stops"),
        "matched_stops",
        (F.col("total_stops") - F.col("matched_stops")).alias("unmatched_stops"),
        F.round(share, 6).alias("match_rate"),
        (share < LOW_MATCH_RATE).alias("low_match_warning"),
    )


def area_layer_profile(areas: DataFrame) -> DataFrame:
    """Number of features and the detected code and name columns of an area layer."""
    code, name = require_area_columns(areas.columns)
    return areas.agg(F.count(F.lit(1)).alias("feature_count")).select(
        "feature_count", F.lit(code).alias("code_column"), F.lit(name).alias("name_column")
    )
