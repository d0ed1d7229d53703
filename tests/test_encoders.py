import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlink.functions import grams as g
from emberlink.functions import dense
from emberlink.functions.dense import FAN, encode_dense, main_axes, tf_idf


def brute(text, n, width):
    codes = [ord(c) for c in (text or "").lower()]
    size, found = min(n, len(codes)), {}
    for i in range(len(codes) - size + 1 if codes else 0):
        h = 0
        for c in codes[i : i + size]:
            h = (h * g.BASE + c) % g.PRIME
        found[h % width] = found.get(h % width, 0) + 1
    return sorted(found.items())


TEXTS = [None, "", "a", "AB", "abc", "Añ😀éx ABC abc", "x" * 70_000 + "yz" * 40_000, "q" * (g.PIECE + 2), "q" * (g.PIECE + 1), "abc"]


@pytest.mark.parametrize("n", [1, 3, 4])
def test_counts_equal_brute_force(spark, n):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    rows = df.select("text", g.gram_counts("text", n, 97).alias("some"), g.dense_counts("text", n, 97).alias("every")).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        want = brute(row.text, n, 97)
        assert [tuple(e) for e in row.some] == want
        assert row.every == [dict(want).get(b, 0) for b in range(97)]


def themes(rows, seed=5):
    rng = random.Random(seed)
    words = [["fire", "smoke", "burn", "forest"], ["slide", "mud", "slope", "rain"], ["market", "stock", "price", "trade"]]
    return [" ".join(rng.choices(words[i % 3], k=12)) for i in range(rows)]


def matrix_of(df, width):
    rows = df.orderBy("id").collect()
    a = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        a[i, row["__at"]] = row["__weight"]
    return a


def test_axes_equal_a_dense_decomposition(spark):
    df = spark.createDataFrame(list(enumerate(themes(240))), "id int, text string")
    counted = df.withColumn("__grams", g.gram_counts("text", 3, 128))
    (weighted,) = tf_idf([counted], 128)
    a = matrix_of(weighted, 128)
    grams = [dict(brute(r.text, 3, 128)) for r in df.orderBy("id").collect()]
    tf = np.array([[t.get(b, 0) for b in range(128)] for t in grams], dtype=float)
    plain = tf * np.log((len(tf) + 1) / ((tf > 0).sum(axis=0) + 1))
    assert np.allclose(a, plain / np.linalg.norm(plain, axis=1, keepdims=True))

    _, s, vt = np.linalg.svd(a)
    # More tasks than one merge takes, some of them without a row: two levels of merging.
    axes = main_axes(weighted.repartition(FAN + 9, "id").select("__at", "__weight"), 128, 6, passes=4)
    assert np.allclose(axes.T @ axes, np.eye(6), atol=1e-9)
    kept = np.linalg.norm(a @ axes) ** 2
    assert kept >= 0.999 * (s[:6] ** 2).sum()
    gaps = abs(np.sum(axes[:, :2] * vt[:2].T, axis=0))
    assert (gaps > 0.999).all()


def test_few_directions_are_exact(spark):
    rows = [([0, 5], [1.0, 2.0]), ([0, 5], [2.0, 4.0]), ([3], [1.0]), ([], [])] * 5
    df = spark.createDataFrame(rows, "__at array<int>, __weight array<double>")
    axes = main_axes(df, 8, 4)
    a = np.zeros((len(rows), 8))
    for i, (at, weight) in enumerate(rows):
        a[i, at] = weight
    assert np.allclose(a @ axes @ axes.T, a) and np.allclose(axes[:, 2:], 0)


def test_vectors_bring_themes_together(spark):
    texts = themes(90)
    a = spark.createDataFrame(list(enumerate(texts[:60])) + [(100, None), (101, "")], "id int, text string").withColumn("extra", F.lit(1))
    b = spark.createDataFrame([(i, t) for i, t in enumerate(texts[60:])] + [(30, texts[0]), (31, texts[0])], "no int, body string")
    va, vb = encode_dense((a, "text"), (b, "body"), dims=4, width=512)
    assert va.columns == ["id", "text", "extra", "vector"] and vb.columns == ["no", "body", "vector"]
    left = {r.id: np.array(r.vector) for r in va.collect()}
    right = {r.no: np.array(r.vector) for r in vb.collect()}
    assert set(left) == set(range(60)) and set(right) == set(range(32))
    assert all(abs(np.linalg.norm(v) - 1) < 1e-5 for v in [*left.values(), *right.values()])
    assert np.array_equal(right[30], right[31]) and left[0] @ right[30] == pytest.approx(1, abs=1e-5)
    for i, v in left.items():
        best = max(range(30), key=lambda j: v @ right[j])
        assert best % 3 == i % 3


def test_no_text_and_equal_texts(spark):
    none = spark.createDataFrame([(1, None), (2, "")], "id int, text string")
    (empty,) = encode_dense((none, "text"), dims=2, width=64)
    assert empty.collect() == []
    same = spark.createDataFrame([(i, "same text") for i in range(5)], "id int, text string")
    (vectors,) = encode_dense((same, "text"), dims=2, width=64)
    # Every gram is in every text, so nothing tells the texts apart: zero vectors.
    assert [r.vector for r in vectors.collect()] == [[0.0, 0.0]] * 5


def test_what_tasks_hold_is_checked(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    with pytest.raises(ValueError, match="more than"):
        encode_dense((df, "text"), dims=1000, width=1 << 16)


def test_grams_are_counted_a_batch_at_a_time(spark):
    df = spark.createDataFrame([(1, "some text")], "id int, text string")
    for counted in (g.gram_counts("text"), g.dense_counts("text", width=8)):
        plan = df.select(counted.alias("c")).where(F.size("c") > 0)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan


def test_dense_rows_equal_sparse_rows(monkeypatch):
    rng = np.random.default_rng(4)
    sizes = np.array([0, 5, 0, 40, 64, 1, 0])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    buckets = np.concatenate([np.sort(rng.choice(64, s, replace=False)) for s in sizes]).astype(np.int32)
    weights, matrix = rng.standard_normal(len(buckets)), rng.standard_normal((64, 5))
    plain = np.zeros((len(sizes), 64))
    plain[np.repeat(np.arange(len(sizes)), sizes), buckets] = weights
    for limit, near in ((12, 1 << 12), (0, 1 << 12), (0, 7)):
        monkeypatch.setattr(dense, "_DENSE", limit)
        monkeypatch.setattr(dense, "_NEAR", near)
        assert (dense._as_dense(starts, buckets, weights, 64) is None) == (limit == 0)
        assert np.allclose(dense._times(starts, buckets, weights, matrix), plain @ matrix)
        sums = np.ones((64, 5))
        dense._add_transposed(sums, starts, buckets, weights, matrix)
        assert np.allclose(sums, 1 + plain.T @ (plain @ matrix))


def test_weights_are_made_where_they_are_multiplied(spark):
    df = spark.createDataFrame(list(enumerate(themes(120))), "id int, text string").withColumn("__grams", g.gram_counts("text", 3, 256))
    (weighted,) = tf_idf([df], 256)
    idf = dense._idf([df.select("__grams")], 256)
    one = main_axes(weighted.select("__at", "__weight"), 256, 4)
    other = main_axes(df.select("__grams"), 256, 4, idf=idf)
    assert np.allclose(one, other, atol=1e-8)
