import random

import pytest

from emberlink.operators import markers as mk


def greedy(rows, radius):
    """One marker after another, by rank."""
    centres, members = [], {}
    for row in sorted(rows, key=lambda r: (r.place.rank, r.x, r.y)):
        reach = [c for c in centres if (c[0] - row.x) ** 2 + (c[1] - row.y) ** 2 <= radius * radius]
        if not reach:
            centres.append((row.x, row.y))
        members.setdefault(reach[0] if reach else (row.x, row.y), []).append(row)
    return {
        c: (len(m), sum(r.points for r in m), round(sum(r.lat_sum for r in m) / sum(r.points for r in m), 6))
        for c, m in members.items()
    }


def frame(spark, rows):
    return spark.createDataFrame(rows, "latitude double, longitude double")


@pytest.mark.parametrize("radius", [1, 20, 80])
def test_equal_to_one_marker_after_another(spark, radius):
    rng = random.Random(radius)
    rows = [(rng.gauss(47, 3), rng.gauss(8, 4)) for _ in range(900)] + [(47.5, 8.5)] * 400 + [(47.5 + i * 1e-3, 8.5) for i in range(300)]
    df = frame(spark, rows)
    marked = mk.markers(df, [2, 7], radius=radius).collect()
    got = {}
    for r in mk.marker_clusters(df, [7, 2, 7], radius=radius).collect():
        got.setdefault(r.zoom, {})[r.x, r.y] = (r.markers, r.points, round(r.center_lat, 6))
    assert set(got) == {2, 7}
    for zoom, clusters in got.items():
        assert clusters == greedy([r for r in marked if r.zoom == zoom], radius)
        assert sum(c[1] for c in clusters.values()) == len(rows)


def test_pixels_nest_and_count_every_point_once(spark):
    rng = random.Random(1)
    df = frame(spark, [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)] + [(90.0, 180.0), (-90.0, -180.0)])
    rows = mk.markers(df, [0, 5]).collect()
    for zoom in (0, 5):
        here = [r for r in rows if r.zoom == zoom]
        assert sum(r.points for r in here) == 502
        assert all(0 <= r.x < 256 * 2**zoom and 0 <= r.y < 256 * 2**zoom for r in here)
    at_zero = {(r.x, r.y): r.points for r in rows if r.zoom == 0}
    summed = {}
    for r in rows:
        if r.zoom == 5:
            summed[r.x >> 5, r.y >> 5] = summed.get((r.x >> 5, r.y >> 5), 0) + r.points
    assert at_zero == summed


def test_rows_without_a_place_and_no_rows(spark):
    bad = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf")), (91.0, 0.0)]
    assert mk.marker_clusters(frame(spark, bad), [3]).collect() == []
    (one,) = mk.marker_clusters(frame(spark, bad + [(10.0, 20.0)] * 3), [3]).collect()
    assert (one.markers, one.points) == (1, 3) and one.center_lat == pytest.approx(10) and one.center_lon == pytest.approx(20)
