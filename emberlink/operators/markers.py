"""Marker clusters of a map: greedy clustering by radius, for each zoom level.

Points fall on pixels of the web map (spherical Mercator, 256 pixels a tile), and equal pixels become one marker with a count, so a crowded
place is one row. Markers are taken by rank; the next marker that no earlier centre reaches becomes a centre, and each marker
belongs to the first centre within ``radius`` pixels. That is a sequential rule, and its result is found in rounds:
cells have the radius as side, so whatever reaches a marker lies in the nine cells around it, and a marker that ranks first among the
undecided in its nine cells is a centre whatever happens elsewhere. What new centres reach leaves, and the next round begins. Cells tell
their neighbours one rank and at most four centres; markers are never paired with each other. Ranks are hashes of the place, which
keeps the number of rounds near the logarithm of the number of markers; every round makes at least one centre.

Points without a place, or with one that is not finite or no latitude, are left out; latitudes beyond the map's edge (85.05) move to it. Clusters
do not reach over the date line. Repeated points count each time.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from emberlink.session import cut_lineage

RADIUS = 80
_EDGE = math.degrees(math.atan(math.sinh(math.pi)))
_CELL = ["zoom", "cell_x", "cell_y"]


def markers(df: DataFrame, zooms: Iterable[int], latitude: str = "latitude", longitude: str = "longitude", radius: int = RADIUS) -> DataFrame:
    """``(zoom, x, y, points, lat_sum, lon_sum, place, cell_x, cell_y)``: one row per zoom and pixel that has a point.

    Raw rows are counted once, at the finest zoom; coarser pixels add up finer ones. ``place`` holds what a marker is ranked by.
    """
    zooms = sorted(set(zooms))
    finest = zooms[-1]
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    pixels = 256 * 2**finest
    bound = F.radians(F.least(F.greatest(lat, F.lit(-_EDGE)), F.lit(_EDGE)))
    across = (lon + 180) / F.lit(360.0) * F.lit(float(pixels))
    down = (F.lit(1.0) - F.asinh(F.tan(bound)) / F.lit(math.pi)) / 2 * F.lit(float(pixels))

    def pixel(value: Column) -> Column:
        return F.least(F.greatest(F.floor(value).cast("long"), F.lit(0)), F.lit(pixels - 1))

    fine = (
        df.where((F.abs(lat) <= 90) & (F.abs(lon) <= 180))
        .select(pixel(across).alias("fine_x"), pixel(down).alias("fine_y"), lat.alias("lat"), lon.alias("lon"))
        .groupBy("fine_x", "fine_y")
        .agg(F.count(F.lit(1)).alias("points"), F.sum("lat").alias("lat_sum"), F.sum("lon").alias("lon_sum"))
    )
    levels = fine.withColumn("zoom", F.explode(F.array(*[F.lit(z) for z in zooms])))
    coarse = [F.expr(f"shiftright(fine_{axis}, {finest} - zoom)").alias(axis) for axis in ("x", "y")]
    merged = levels.groupBy("zoom", *coarse).agg(*[F.sum(c).alias(c) for c in ("points", "lat_sum", "lon_sum")])
    return merged.withColumns(
        {
            "place": F.struct(F.xxhash64("zoom", "x", "y").alias("rank"), F.col("x"), F.col("y")),
            "cell_x": F.floor(F.col("x") / radius).cast("long"),
            "cell_y": F.floor(F.col("y") / radius).cast("long"),
        }
    )


def _spread(df: DataFrame) -> DataFrame:
    """Each row in the nine cells around its own."""
    step = F.array(*[F.lit(s) for s in (-1, 0, 1)])
    beside = df.withColumn("__dx", F.explode(step)).withColumn("__dy", F.explode(step))
    return beside.withColumns({"cell_x": F.col("cell_x") + F.col("__dx"), "cell_y": F.col("cell_y") + F.col("__dy")}).drop("__dx", "__dy")


def _reach(df: DataFrame, centres: DataFrame) -> DataFrame:
    """``df`` with ``near``: the centres (by rank) in the nine cells around, at most four a cell."""
    near = _spread(centres).groupBy(*_CELL).agg(F.array_sort(F.collect_list("centre")).alias("near"))
    return df.join(near, _CELL, "left")


def _within(radius: int):
    def test(c: Column) -> Column:
        dx, dy = c["x"] - F.col("place.x"), c["y"] - F.col("place.y")
        return dx * dx + dy * dy <= radius * radius

    return test


def centres_of(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(zoom, cell_x, cell_y, centre)`` of all clusters."""
    found = None
    open_ones = marked.select(*_CELL, "place")
    while True:
        first = open_ones.groupBy(*_CELL).agg(F.min("place").alias("centre"))
        around = _spread(first).groupBy(*_CELL).agg(F.min("centre").alias("least"))
        new = cut_lineage(first.join(around, _CELL).where("centre = least").drop("least"), "centres")
        found = new if found is None else found.unionByName(new)
        left = _reach(open_ones, new).where(~F.coalesce(F.exists("near", _within(radius)), F.lit(False)))
        open_ones = cut_lineage(left.drop("near"), "open")
        if open_ones.isEmpty():
            return found


def marker_clusters(
    df: DataFrame, zooms: Iterable[int], latitude: str = "latitude", longitude: str = "longitude", radius: int = RADIUS
) -> DataFrame:
    """``(zoom, x, y, markers, points, center_lat, center_lon)``: a row per cluster, by the pixel of its centre, with its points' mean place."""
    marked = cut_lineage(markers(df, zooms, latitude, longitude, radius), "markers")
    owner = F.get(F.filter("near", _within(radius)), F.lit(0))
    return (
        _reach(marked, centres_of(marked, radius))
        .withColumn("centre", owner)
        .groupBy("zoom", "centre")
        .agg(F.count(F.lit(1)).alias("markers"), *[F.sum(c).alias(c) for c in ("points", "lat_sum", "lon_sum")])
        .select(
            "zoom", F.col("centre.x").alias("x"), F.col("centre.y").alias("y"), "markers", "points",
            (F.col("lat_sum") / F.col("points")).alias("center_lat"), (F.col("lon_sum") / F.col("points")).alias("center_lon"),
        )
    )
