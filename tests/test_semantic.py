import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlink.functions.encode import encode_hashed, encode_with
from emberlink.operators import semantic
from emberlink.operators.semantic import link_semantic, top1


def frames(spark, arts, events):
    a = spark.createDataFrame([(f"a{i:04d}", [float(x) for x in v]) for i, v in enumerate(arts)], "article_id string, vector array<float>")
    e = spark.createDataFrame(
        [(i, f"e{i:05d}", "wildfire" if i % 3 else None, [float(x) for x in v]) for i, v in enumerate(events)],
        "ord long, event_id string, disaster_type string, vector array<float>",
    )
    return a.repartition(3), e.repartition(5)


def brute(arts, events):
    a = np.asarray(arts, dtype=np.float32).astype(float)
    e = np.asarray(events, dtype=np.float32).astype(float)
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    sims = np.round(unit(a) @ unit(e).T, 12)
    return {f"a{i:04d}": (s.max(), f"e{int(s.argmax()):05d}") for i, s in enumerate(sims)}


def data(kind):
    rng = np.random.default_rng(3)
    if kind == "random":
        return rng.normal(size=(60, 16)), rng.normal(size=(300, 16))
    centers = rng.normal(size=(6, 16)) * 4
    arts = centers[rng.integers(0, 6, 60)] + rng.normal(size=(60, 16))
    events = centers[rng.integers(0, 6, 300)] + rng.normal(size=(300, 16))
    events[100:200] = events[0]  # a third are copies of one event
    arts[10] = 0.0
    events[250] = 0.0
    return arts, events


@pytest.mark.parametrize("kind", ["random", "clustered"])
@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_top1_equals_brute_force(spark, kind, limit):
    arts, events = data(kind)
    a, e = frames(spark, arts, events)
    want = brute(arts, events)
    out = top1(a, e, None, "ord", limit, block_rows=25)
    have = {r.article_id: (r.similarity, r.event_id) for r in out.collect()}
    assert have.keys() == want.keys()
    for k in want:
        assert have[k][0] == pytest.approx(want[k][0], abs=1e-9)
        assert have[k][1] == want[k][1]


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_threshold_ties_and_priority(spark, limit):
    a = spark.createDataFrame(
        [
            ("edge", [4.0, 0.0, 0.0], "in Valais"),
            ("low", [0.0, 0.0, 1.0], "in Valais"),
            ("tie", [0.0, 2.0, 0.0], "valais"),
            ("zero", [0.0, 0.0, 0.0], "Blatten"),
            ("none", None, "Blatten"),
        ],
        "article_id string, vector array<double>, text string",
    )
    # cosine of "edge" with e1 is 0.4 up to rounding of the root
    e = spark.createDataFrame(
        [
            ("e1", "wildfire", [2.0, 0.0, -float(np.sqrt(21))]),
            ("e3", None, [0.0, 1.0, 0.0]),
            ("e2", None, [0.0, 5.0, 0.0]),
        ],
        "event_id string, disaster_type string, vector array<double>",
    )
    rows = {r.article_id: r for r in link_semantic(a, e, text="text", max_broadcast_bytes=limit, block_rows=2).collect()}
    assert set(rows) == {"edge", "tie"}
    assert rows["edge"].semantic_score == 0.4 and rows["edge"].priority_match is True
    assert rows["edge"].linked_disaster_type == "wildfire"
    assert rows["tie"].semantic_linked_disaster_id == "e2" and rows["tie"].priority_match is None
    assert rows["tie"].linked_disaster_type == "landslide"


def test_no_events_is_a_no_op(spark):
    a, e = frames(spark, [[1, 2]], [[1, 2]])
    assert link_semantic(a, e.limit(0)).count() == 0
    assert link_semantic(a.limit(0), e).count() == 0


def test_encoders(spark):
    a = spark.createDataFrame([("a", "wildfire in 46.4,7.8"), ("b", "stock market news"), ("c", "")], "article_id string, text string")
    e = spark.createDataFrame([("f", "wildfire in 46.4,7.8 on 2024-01-02"), ("g", "landslide in 1.0,2.0 on 2024-01-02")], "event_id string, text string")
    av, ev = encode_hashed((a, "text"), (e, "text"))
    out = top1(av, ev.withColumn("disaster_type", F.lit("x"))).collect()
    best = {r.article_id: r for r in out}
    assert set(best) == {"a", "b"} and best["a"].event_id == "f" and best["a"].similarity > 0.5

    def make():
        return lambda texts: [[len(t), 1.0] for t in texts]

    got = {r.article_id: r.vector for r in encode_with(a, "text", make).collect()}
    assert got == {"a": [20.0, 1.0], "b": [17.0, 1.0]}


def test_threshold_is_the_same_on_both_sides_of_the_limit(spark):
    rng = np.random.default_rng(3)
    rows = lambda n, k: [(f"{k}{i}", [float(x) for x in rng.standard_normal(6)]) for i in range(n)]
    a = spark.createDataFrame(rows(120, "a"), "article_id string, vector array<double>")
    e = spark.createDataFrame(rows(90, "e"), "event_id string, vector array<double>").withColumn("disaster_type", F.lit("wildfire"))
    for threshold in (None, 0.6, 0.9, 0.999):
        one, other = (sorted(map(tuple, top1(a, e, threshold, max_broadcast_bytes=limit, block_rows=16).collect())) for limit in (1 << 20, 0))
        assert one == other


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_bad_vectors_touch_nobody_else(spark, limit):
    nan, inf = float("nan"), float("inf")
    articles = spark.createDataFrame(
        [(1, [1.0, 0.1]), (2, [nan, 1.0]), (3, [0.2, 1.0]), (4, None), (5, []), (6, [1.0, None]), (7, [inf, 0.0]), (8, [1.0, 2.0, 3.0]), (9, [5.0]), (10, [0.0, 0.0])],
        "article_id long, vector array<double>",
    )
    events = spark.createDataFrame(
        [("a", "fire", [1.0, 0.0]), ("b", "flood", [nan, nan]), ("c", "storm", [0.0, 1.0]), ("d", "x", [1.0]), ("e", "x", None)], "event_id string, disaster_type string, vector array<double>"
    )
    got = {r.article_id: r.event_id for r in semantic.top1(articles, events, max_broadcast_bytes=limit).collect()}
    assert got == {1: "a", 3: "c", 10: "a"}
    why = {r.article_id: r.reason for r in semantic.left_out(articles, 2).collect()}
    assert why == {2: "not finite", 4: "missing", 5: "missing", 6: "not finite", 7: "not finite", 8: "width", 9: "width"}


def _structured(n, width, rank, seed, noise=0.02):
    """Unit vectors near a subspace, in clusters."""
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((width, width)))[0][:, :rank]
    centres = np.random.default_rng(1).standard_normal((40, rank))
    v = (centres[rng.integers(0, 40, n)] + 0.2 * rng.standard_normal((n, rank))) @ basis.T
    v += noise * rng.standard_normal((n, width))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("kind", ["structured", "random", "ties", "zero"])
def test_bounds_change_no_answer(kind):
    rng = np.random.default_rng(5)
    if kind == "structured":
        rows, others = _structured(700, 64, 6, 2), _structured(9000, 64, 6, 3)
    elif kind == "random":
        rows, others = rng.standard_normal((300, 32)), rng.standard_normal((5000, 32))
    elif kind == "ties":
        others = np.tile(_structured(50, 64, 6, 3), (100, 1))
        rows = others[:60].copy()
    else:
        rows, others = np.zeros((5, 64)), _structured(100, 64, 6, 3)
    unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n)
    rows, others = unit(rows), unit(others)
    plain, pruned = semantic._best(rows, others), semantic._best(rows, others, semantic.Axes(others))
    assert np.allclose(plain[0], pruned[0], atol=2e-12) and (plain[1] == pruned[1]).all()
    if kind == "structured":
        assert pruned[2] < 0.1 * len(rows) * len(others)
    if kind == "random":
        assert pruned[2] == len(rows) * len(others)  # nothing can be skipped, and nothing is


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_products_are_counted(spark, limit):
    a, e = _structured(300, 64, 5, 8), _structured(3000, 64, 5, 9)
    articles = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "article_id long, vector array<double>")
    events = spark.createDataFrame([(i, "x", v.tolist()) for i, v in enumerate(e)], "event_id long, disaster_type string, vector array<double>")
    counters = (spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0))
    got = {r.article_id: r.event_id for r in top1(articles, events, max_broadcast_bytes=limit, products=counters).collect()}
    assert got == dict(enumerate((a @ e.T).round(12).argmax(axis=1).tolist()))
    assert counters[0].value == 300 * 3000 and counters[1].value < 0.2 * counters[0].value


def test_blocks_meet_without_copies(spark):
    """No block goes through an exchange to meet the others, and events with equal vectors are compared once."""
    a, e = _structured(200, 16, 3, 4), np.repeat(_structured(60, 16, 3, 5), 5, axis=0)
    articles = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "article_id long, vector array<float>")
    events = spark.createDataFrame([(i, "x", v.tolist()) for i, v in enumerate(e)], "event_id long, disaster_type string, vector array<float>")
    counters = (spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0))
    found = top1(articles, events, max_broadcast_bytes=0, block_rows=16, products=counters)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "CoGroup" not in plan and "Generate" not in plan
    want = {r.article_id: r.event_id for r in top1(articles, events).collect()}
    assert {r.article_id: r.event_id for r in found.collect()} == want and all(i % 5 == 0 for i in want.values())
    assert counters[0].value == 200 * 60


def test_null_events_and_repeated_articles_in_blocks(spark):
    articles = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 1.0]), (2, [0.0, 0.0])], "article_id long, vector array<double>")
    events = spark.createDataFrame(
        [(None, "x", [1.0, 0.0]), (7, "x", [2.0, 0.0]), (9, None, [0.0, 3.0]), (8, "y", [0.0, 3.0])],
        "event_id long, disaster_type string, vector array<double>",
    )
    got = top1(articles, events, max_broadcast_bytes=0, block_rows=1).collect()
    assert {r.article_id: (r.event_id, r.disaster_type) for r in got} == {1: (7, "x"), None: (8, "y"), 2: (7, "x")} and len(got) == 3


def test_floats_in_blocks_equal_doubles(spark):
    a, e = _structured(90, 16, 3, 6).astype(np.float32), _structured(70, 16, 3, 7).astype(np.float32)
    frames_of = lambda kind: (
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], f"article_id long, vector array<{kind}>"),
        spark.createDataFrame([(i, "x", v.tolist()) for i, v in enumerate(e)], f"event_id long, disaster_type string, vector array<{kind}>"),
    )
    one, other = (sorted(map(tuple, top1(*frames_of(kind), max_broadcast_bytes=0, block_rows=8).collect())) for kind in ("float", "double"))
    assert one == other and len(one) == 90


@pytest.mark.parametrize("kind", ["near", "outliers", "far", "equal"])
def test_groups_change_no_answer(kind):
    """Texts are near a few middles, events are not near a subspace: most events cannot win, and are not multiplied."""
    rng = np.random.default_rng(8)
    unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n)
    others = unit(rng.standard_normal((6000, 48)))
    rows = unit(rng.standard_normal((5, 48)))[rng.integers(0, 5, 1500)] + 0.01 * rng.standard_normal((1500, 48))
    if kind == "outliers":
        rows[::50] = rng.standard_normal((30, 48))
        rows[7], others[11] = 0.0, 0.0
    elif kind == "far":
        rows = rng.standard_normal((1500, 48))
    elif kind == "equal":
        others[3000:] = others[:3000]
        rows[100:200] = others[50]
    rows = unit(rows)
    axes = semantic.Axes(others)
    assert not axes.worth
    plain, grouped = semantic._best(rows, others), semantic._best(rows, others, axes)
    assert np.allclose(plain[0], grouped[0], atol=2e-12) and (plain[1] == grouped[1]).all()
    floor = plain[0] - np.where(np.arange(len(rows)) % 2, 0.0, 0.1)
    again = semantic._best(rows, others, axes, floor=floor)
    assert (again[1] == plain[1]).all()
    above = semantic._best(rows, others, axes, floor=plain[0] + 0.01)
    assert (above[0] <= plain[0] + 2e-12).all()
    if kind == "near":
        assert grouped[2] < 0.1 * len(rows) * len(others)
    if kind == "far":
        assert grouped[2] == len(rows) * len(others)


def test_small_blocks_are_put_together(spark):
    """Copies leave few events in a block; what meets the articles is one block."""
    a, e = _structured(100, 16, 16, 4, 0.3), np.repeat(_structured(90, 16, 16, 5, 0.3), 40, axis=0)
    articles = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "article_id long, vector array<float>")
    events = spark.createDataFrame([(i, "x", v.tolist()) for i, v in enumerate(e)], "event_id long, disaster_type string, vector array<float>")
    names = ["event_id", "disaster_type"]
    blocks = semantic._in_blocks(events.repartition(4, "vector").sortWithinPartitions("vector", "event_id"), names, 50, "test", once=True)
    schema = semantic._arrow_schema(blocks.schema)
    joined = blocks.coalesce(1).mapInArrow(semantic._together(schema, names, 1000), blocks.schema).collect()
    assert len(joined) == 1 and len(joined[0].matrix) == 90 * 16 * 4
    assert sorted(joined[0].event_id) == list(range(0, 3600, 40)) and joined[0].disaster_type == ["x"] * 90
    got = {r.article_id: r.event_id for r in top1(articles, events, max_broadcast_bytes=0, block_rows=50).collect()}
    assert got == {r.article_id: r.event_id for r in top1(articles, events).collect()}


def test_texts_are_counted_once(spark):
    """The frames read counts that were written, and no text; without ``keep_text`` the text is not written either."""
    df = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "id int, text string")
    for keep in (True, False):
        (vectors,) = encode_hashed((df, "text"), width=8, keep_text=keep)
        plan = vectors._jdf.queryExecution().analyzed().toString()
        assert "counts" in plan and "lower" not in plan
        assert vectors.columns == (["id", "text", "vector"] if keep else ["id", "vector"])
        assert [r.id for r in vectors.collect()] == [1]
