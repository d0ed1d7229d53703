import math
import random

import pytest
from pyspark.sql import functions as F

from emberlink.functions import geo
from emberlink.operators.nearest import link_space_time


def vincenty(lat1, lon1, lat2, lon2):
    """Iterates to convergence, unlike the engine's fixed number of rounds."""
    a, f = 6378.137, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    big_l = math.radians((lon2 - lon1 + 540) % 360 - 180)
    lam = big_l
    for _ in range(200):
        x = math.cos(u2) * math.sin(lam)
        y = math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam)
        ss = math.hypot(x, y)
        if ss == 0:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sig = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        ca2 = 1 - sa * sa
        c2m = cs - 2 * math.sin(u1) * math.sin(u2) / ca2 if ca2 > 1e-15 else 0.0
        c = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
        new = big_l + (1 - c) * f * sa * (sig + c * ss * (c2m + c * cs * (2 * c2m**2 - 1)))
        done, lam = abs(new - lam) < 1e-15, new
        if done:
            break
    w = ca2 * (a * a - b * b) / (b * b)
    ka = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    kb = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    d = kb * ss * (c2m + kb / 4 * (cs * (2 * c2m**2 - 1) - kb / 6 * c2m * (4 * ss**2 - 3) * (4 * c2m**2 - 3)))
    return b * ka * (sig - d)


def haversine(lat1, lon1, lat2, lon2):
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def frames(spark, articles, fires):
    a = spark.createDataFrame(
        articles, "article_id string, query_lat double, query_lon double, day string"
    ).withColumn("published_at", F.to_timestamp("day"))
    f = spark.createDataFrame(fires, "fire_id string, latitude double, longitude double, acq_date string")
    return a, f.withColumn("acq_date", F.to_date("acq_date"))


def brute(articles, fires, dist, days=2, km=50.0, weight=10.0):
    import datetime as dt

    out = {}
    for aid, alat, alon, aday in articles:
        best = None
        for fid, flat, flon, fday in fires:
            gap = abs((dt.datetime.fromisoformat(aday).date() - dt.date.fromisoformat(fday)).days)
            if gap > days:
                continue
            d = dist(alat, alon, flat, flon)
            if d > km:
                continue
            cand = (round(d + weight * gap, 9), fid)
            best = cand if best is None or cand < best else best
        if best:
            out[aid] = best
    return out


def got(df):
    return {r.article_id: (r.match_score, r.linked_fire_id) for r in df.collect()}


REGIONS = {
    "alps": (46, 48, 6, 9),
    "dateline": (-1, 1, 179, 181),
    "north pole": (89, 90, -180, 180),
    "south pole": (-90, -89.2, -180, 180),
    "prime meridian": (50.8, 51.8, -1, 1),
}


def scatter(seed, box, n_articles, n_fires):
    rng = random.Random(seed)
    lat0, lat1, lon0, lon1 = box

    def spot():
        lon = rng.uniform(lon0, lon1)
        return round(rng.uniform(lat0, lat1), 4), round(lon - 360 if lon > 180 else lon, 4)

    arts = [
        (f"a{i}", *spot(), f"2024-01-{rng.randint(1, 9):02d} {rng.randint(0, 23):02d}:30:00")
        for i in range(n_articles)
    ]
    fires = [(f"f{i:04d}", *spot(), f"2024-01-{rng.randint(1, 9):02d}") for i in range(n_fires)]
    return arts, fires


@pytest.mark.parametrize("region", REGIONS)
@pytest.mark.parametrize("max_per_cell", [10_000, 2])
@pytest.mark.parametrize("distance", ["ellipsoid", "sphere"])
def test_equals_brute_force(spark, region, max_per_cell, distance):
    if distance == "sphere" and region not in ("alps", "north pole"):
        pytest.skip("same cells as the ellipsoid run")
    arts, fires = scatter(len(region), REGIONS[region], 120, 200)
    want = brute(arts, fires, vincenty if distance == "ellipsoid" else haversine)
    a, f = frames(spark, arts, fires)
    have = got(link_space_time(a, f, min_semantic=None, distance=distance, max_per_cell=max_per_cell))
    assert have.keys() == want.keys() and len(want) > 5
    for key, (cost, fire) in want.items():
        assert have[key][1] == fire
        assert have[key][0] == pytest.approx(cost, abs=0.0051)


def test_hot_place_with_copies(spark):
    """A third of both sides at one place, another third within a few metres of it."""
    rng = random.Random(5)
    arts, fires = scatter(4, REGIONS["alps"], 60, 60)
    arts += [(f"h{i}", 47.0, 7.0, "2024-01-05 12:00:00") for i in range(60)]
    arts += [(f"j{i}", 47 + rng.random() / 1e4, 7 + rng.random() / 1e4, "2024-01-05 12:00:00") for i in range(60)]
    fires += [(f"h{i:04d}", 47.0, 7.0, "2024-01-05") for i in range(60)]
    fires += [(f"j{i:04d}", 47 + rng.random() / 1e4, 7 + rng.random() / 1e4, "2024-01-06") for i in range(60)]
    a, f = frames(spark, arts, fires)
    want = brute(arts, fires, vincenty)
    have = got(link_space_time(a, f, min_semantic=None, max_per_cell=4))
    assert {k: v[1] for k, v in have.items()} == {k: v[1] for k, v in want.items()}


def test_edges(spark):
    north = 50 / 111.2  # about 50 km on the sphere at 47 N
    arts = [
        ("near", 47.0, 7.0, "2024-01-05 00:00:00"),
        ("day2", 47.0, 20.0, "2024-01-05 00:00:00"),
        ("day3", 47.0, 30.0, "2024-01-05 00:00:00"),
        ("half day before", 47.0, 40.0, "2024-01-04 12:00:00"),
        ("far", 47.0, 50.0, "2024-01-05 00:00:00"),
        ("in reach", 47.0, 60.0, "2024-01-05 00:00:00"),
        ("tie", 47.0, 70.0, "2024-01-05 00:00:00"),
        ("no place", None, 7.0, "2024-01-05 00:00:00"),
        ("same day wins", 47.0, 80.0, "2024-01-05 00:00:00"),
    ]
    fires = [
        ("f1", 47.0, 7.0, "2024-01-05"),
        ("f2", 47.0, 20.0, "2024-01-07"),
        ("f3", 47.0, 30.0, "2024-01-08"),
        ("f4", 47.0, 40.0, "2024-01-05"),
        ("f5", 47.0 + north * 1.002, 50.0, "2024-01-05"),
        ("f6", 47.0 + north * 0.998, 60.0, "2024-01-05"),
        ("f8", 47.0, 70.0, "2024-01-05"),
        ("f7", 47.0, 70.0, "2024-01-05"),
        ("f9", 47.0, 80.0, "2024-01-07"),
        ("f10", 47.1, 80.0, "2024-01-05"),
        ("f0", None, 7.0, "2024-01-05"),
    ]
    a, f = frames(spark, arts, fires)
    have = got(link_space_time(a, f, min_semantic=None, distance="sphere"))
    assert have["near"] == (0.0, "f1")
    assert have["day2"] == (20.0, "f2")
    assert have["half day before"] == (10.0, "f4")
    assert have["tie"][1] == "f7"
    assert have["same day wins"][1] == "f10"
    assert have["in reach"][1] == "f6"
    assert set(have) == {"near", "day2", "half day before", "tie", "in reach", "same day wins"}


def test_semantic_gate(spark):
    a, f = frames(spark, [("x", 47.0, 7.0, "2024-01-05"), ("y", 47.0, 7.0, "2024-01-05"), ("z", 47.0, 7.0, "2024-01-05")], [("f", 47.0, 7.0, "2024-01-05")])
    a = a.withColumn("semantic_score", F.when(F.col("article_id") == "x", 0.2).when(F.col("article_id") == "y", 0.19))
    assert set(got(link_space_time(a, f))) == {"x"}


def test_plan_has_no_nested_loop(spark):
    arts, fires = scatter(1, REGIONS["alps"], 10, 10)
    a, f = frames(spark, arts, fires)
    plan = link_space_time(a, f, min_semantic=None)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan


@pytest.mark.parametrize("reach,tolerance_km", [(0.001, 1e-8), (50, 2e-8), (500, 1e-3)])
def test_ellipsoid_distance_against_iterative_geodesic(spark, reach, tolerance_km):
    rng = random.Random(reach)
    rows = []
    while len(rows) < 400:
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        lat2 = lat + rng.uniform(-1, 1) * reach / 111
        lon2 = lon + rng.uniform(-1, 1) * reach / 111 / max(0.01, math.cos(math.radians(lat)))
        if abs(lat2) <= 90 and haversine(lat, lon, lat2, lon2) <= reach * 1.5:
            rows.append((lat, lon, lat2, lon2))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    df = geo.add_place(geo.add_place(df, "a", "b", "p_", "ellipsoid"), "c", "d", "q_", "ellipsoid")
    for r in geo.add_km(df, "p_", "q_", "ellipsoid").collect():
        assert r.km == pytest.approx(vincenty(r.a, r.b, r.c, r.d), abs=tolerance_km)
