import math
import random

import pytest
from pyspark.sql import functions as F

from emberlink.operators import outlines as ol


def by_hand(lat, lon, outlines):
    """Plain ray casting; rings come without jumps, points are tried a turn to either side."""
    if lat is None or lon is None or not (math.isfinite(lat) and math.isfinite(lon)) or abs(lat) > 90:
        return None
    for name, rings in outlines:
        met = 0
        for ring in rings:
            for k in (-720.0, -360.0, 0.0, 360.0, 720.0):
                for (y1, x1), (y2, x2) in zip(ring, [*ring[1:], ring[0]]):
                    x = lon + k
                    met += (y1 > lat) != (y2 > lat) and x < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
        if met % 2:
            return name
    return None


def wrapped(outlines):
    """The same with longitudes in [-180, 180), as files have them."""
    return [(n, [[(y, x - 360 if x >= 180 else x + 360 if x < -180 else x) for y, x in ring] for ring in rings]) for n, rings in outlines]


def star(rng, lat, lon, reach, corners):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [
        (max(-89.0, min(89.0, lat + reach * rng.uniform(0.3, 1) * math.sin(t))), lon + reach * rng.uniform(0.3, 1) * math.cos(t))
        for t in turns
    ]


def assigned(spark, points, outlines, **options):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, latitude double, longitude double")
    found = ol.regions_by_outline(df, ol.outlines_frame(spark, outlines), **options)
    assert found.columns == ["id", "latitude", "longitude", "region"]
    rows = found.collect()
    assert len(rows) == len(points)
    return [r.region for r in sorted(rows)]


@pytest.mark.parametrize("columns", [36, 1000])
def test_stars_with_holes_equal_ray_casting(spark, columns):
    rng = random.Random(columns)
    outlines = [
        (f"r{i}", [star(rng, lat, lon, 9, 14), star(rng, lat, lon, 3, 6)])
        for i, (lat, lon) in enumerate([(10, 10), (14, 17), (-30, 0), (60, 178), (55, -176)])
    ]
    points = [(rng.uniform(-45, 75), rng.uniform(-12, 30)) for _ in range(1500)]
    points += [(rng.uniform(45, 72), rng.choice([-1, 1]) * rng.uniform(165, 180)) for _ in range(1500)]
    # Vertices (those that wrapping does not round) and places on cell edges too.
    points += [p for _, rings in outlines[:3] for ring in rings for p in ring]
    points += [(float(y), float(x)) for y in range(0, 30, 5) for x in range(0, 30, 5)]
    want = [by_hand(*p, outlines) for p in points]
    assert {None, "r0", "r1", "r3", "r4"} <= set(want)
    assert assigned(spark, points, wrapped(outlines), columns=columns) == want
    if columns == 36:
        assert assigned(spark, points, wrapped(outlines), columns=columns, max_broadcast=0) == want


def test_hole_and_parts_on_either_side_of_the_date_line(spark):
    box = [(0.0, 170.0), (0.0, 190.0), (20.0, 190.0), (20.0, 170.0)]
    hole = [(5.0, -178.0), (5.0, -174.0), (15.0, -174.0), (15.0, -178.0)]
    closed = [(y, x - 360 if x >= 180 else x) for y, x in [*box, box[0]]]
    points = [(10.0, 175.0), (10.0, -179.0), (10.0, -176.0), (10.0, 184.0), (10.0, -172.0), (10.0, 165.0), (10.0, -165.0), (10.0, 0.0), (10.0, 180.0), (10.0, -180.0)]
    assert assigned(spark, points, [("p", [closed, hole])]) == ["p", "p", None, None, "p", None, None, None, "p", "p"]


def test_edges_belong_to_south_and_west(spark):
    box = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)]
    points = [(1.0, 1.5), (1.5, 1.0), (2.0, 1.5), (1.5, 2.0), (1.0, 1.0), (2.0, 2.0)]
    assert assigned(spark, points, [("box", [box])]) == ["box", "box", None, None, "box", None]


def test_rank_and_points_without_a_place(spark):
    box = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]
    inner = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)]
    points = [(1.5, 1.5), (3.0, 3.0), (None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf")), (91.0, 1.0), (1.5, 361.5)]
    assert assigned(spark, points, [("all", [box]), ("inner", [inner])]) == ["all", "all", None, None, None, None, None, "all"]
    assert assigned(spark, points, [("inner", [inner]), ("all", [box])]) == ["inner", "all", None, None, None, None, None, "inner"]


def test_empty_and_degenerate(spark):
    line = [(0.0, 0.0), (5.0, 5.0)]
    assert assigned(spark, [(2.0, 2.0), (2.0, 2.0)], [("line", [line]), ("none", []), ("point", [[(2.0, 2.0)]])]) == [None, None]
    outlines = ol.outlines_frame(spark, [])
    one = spark.createDataFrame([(1, 2.0, 2.0)], "row int, latitude double, longitude double")
    assert [tuple(r) for r in ol.regions_by_outline(one, outlines).collect()] == [(1, 2.0, 2.0, None)]
    assert ol.regions_by_outline(one.where("false"), outlines).count() == 0


def test_most_cells_need_no_edges(spark):
    box = [(10.0, 10.0), (10.2, 30.0), (30.0, 29.7), (29.8, 10.1)]
    cells = ol.cover(ol.outlines_frame(spark, [("box", [box])])).withColumn("whole", F.col("regions")[0]["edges"].isNull())
    counts = {r.whole: r["count"] for r in cells.groupBy("whole").count().collect()}
    assert counts[True] > 15 * counts[False]
