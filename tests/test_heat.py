import math
import random

import pytest

from emberlink.operators.reports import heat_layer


def whole_kernel(rows, cell, sigma, reach):
    columns = round(360 / cell)
    raw = {k: math.exp(-k * k / (2 * sigma * sigma)) for k in range(-reach, reach + 1)}
    total, out = sum(raw.values()), {}
    for lat, lon, weight in rows:
        y, x = math.floor(lat / cell), math.floor(lon / cell)
        for a, u in raw.items():
            for b, v in raw.items():
                at = (y + a, (x + b + columns // 2) % columns - columns // 2)
                if -90 <= at[0] * cell <= 90:
                    out[at] = out.get(at, 0) + weight * u * v / total**2
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "latitude double, longitude double, frp double")


def test_equal_to_the_whole_kernel(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(0, 9)) for _ in range(60)]
    rows += [(10.0, 179.9, 2.0), (10.0, -179.9, 3.0), (89.9, 0.0, 1.0), (-90.0, 5.0, 1.0), (48.0, 8.0, 1.0)] + [(48.0, 8.0, 1.0)] * 50
    for weight, plain in (("frp", rows), (None, [(a, b, 1.0) for a, b, _ in rows])):
        got = {(r.cell_lat, r.cell_lon): r.heat for r in heat_layer(frame(spark, rows), 2.0, 1.3, 3, weight).collect()}
        want = whole_kernel(plain, 2.0, 1.3, 3)
        assert set(got) == set(want)
        assert all(got[c] == pytest.approx(want[c], abs=1e-9) for c in want)


def test_heat_is_kept_away_from_the_poles(spark):
    got = heat_layer(frame(spark, [(0.0, 179.0, 5.0)]), 1.0, 2.0, 6, "frp").collect()
    assert sum(r.heat for r in got) == pytest.approx(5.0) and len(got) == 169
    assert all(-180 <= r.cell_lon < 180 for r in got)


def test_rows_without_a_place_or_weight(spark):
    bad = [(None, 1.0, 1.0), (1.0, None, 1.0), (float("nan"), 1.0, 1.0), (1.0, float("inf"), 1.0), (1.0, 1.0, None)]
    assert heat_layer(frame(spark, bad), 1.0, 1.0, 2, "frp").collect() == []
    assert heat_layer(frame(spark, bad).where("false"), 1.0, 1.0, 2).collect() == []


def test_cells_must_divide_a_turn(spark):
    with pytest.raises(ValueError, match="whole number"):
        heat_layer(frame(spark, []), 0.7, 1.0, 2)
    with pytest.raises(ValueError, match="wider"):
        heat_layer(frame(spark, []), 90.0, 1.0, 2)
