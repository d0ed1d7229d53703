"""Both searches against brute force, and what they do with unusable rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlink.llm import rabitq, topk

ASKS = lambda: F.expr("vec_id % 20 = 0")
SCHEMA = "vec_id long, embedding array<float>, id string, data string"


def _brute(rows, k, scale=None):
    clean = [(i, np.array(v, dtype=np.float64)) for i, v in rows]
    if scale:
        clean = [(i, np.floor(scale * v)) for i, v in clean]
    out = {}
    for q, vector in clean:
        if q % 20 == 0:
            scored = sorted((-float(vector @ v), i) for i, v in clean if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def _lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], float(r["score"])))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    v = rng.standard_normal((900, 32)).astype(np.float32)
    v[300:600] = v[300]  # a third of all rows are copies
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


def test_top_k_is_exact_with_ties(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], SCHEMA).repartition(5)
    got = _lists(topk.top_k_integer(df, ASKS(), 20))
    assert got == _brute(vectors, 20, scale=64.0)


def test_one_bit_codes_find_the_nearest(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], SCHEMA).repartition(5)
    got, want = _lists(rabitq.nearest(df, ASKS(), 20)), _brute(vectors, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.99
    for q in want:
        for (_, a), (_, b) in zip(got[q], want[q]):
            assert a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("search", [lambda df: topk.top_k_integer(df, ASKS(), 20), lambda df: rabitq.nearest(df, ASKS(), 20)])
def test_unusable_rows(spark, search):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (1, [1.0, 1.0]), (20, [1.0, -1.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    got = _lists(search(df))
    assert set(got) == {0, 20}
    assert [i for i, _ in got[0]] == [1, 1, 20]
    assert search(df.where("false")).count() == 0


def test_zero_vectors(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], "", ""), (1, [1.0, 1.0], "", ""), (20, [1.0, 0.0], "", "")], SCHEMA)
    assert set(_lists(topk.top_k_integer(df, ASKS(), 20))) == {0, 20}
    assert _lists(rabitq.nearest(df, ASKS(), 20)) == {20: [(1, 1.0)]}


def test_large_components_do_not_round(spark):
    a, b = [2.0**30, 1.0], [2.0**20, 1.0]
    df = spark.createDataFrame([(0, a, "", ""), (1, b, "", "")], SCHEMA)
    assert _lists(topk.top_k_integer(df, ASKS(), 5))[0][0][1] == float(2**36 * 2**26 + 64 * 64)
    huge = spark.createDataFrame([(0, [3e38, 1.0], "", ""), (1, [3e38, 1.0], "", "")], SCHEMA)
    assert topk.top_k_integer(huge, ASKS(), 5).first()["score"] == 2**63 - 1


def test_error_bounds_hold():
    rng = np.random.default_rng(1)
    v, q = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    mean, turn = v.mean(axis=0), rabitq.rotation(64)
    guess, wide = rabitq.estimate(q, mean, turn, *rabitq.encode(v, mean, turn), 3.0)
    assert np.mean(np.abs(guess - q @ v.T) <= wide) > 0.99
