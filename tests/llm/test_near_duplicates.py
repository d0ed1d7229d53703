"""Darts against the similarity they estimate, and classes against all pairs."""

import itertools
import random

import numpy as np
import pytest

from emberlink.llm import dart_minhash as dm
from emberlink.llm.components import connected_components


def _agree(a, b):
    return float((a == b).mean())


@pytest.mark.parametrize("n,share", [(9, 0.8), (80, 0.5), (2500, 0.8), (400, 0.2)])
def test_agreement_estimates_jaccard(n, share):
    rng = np.random.default_rng(n)
    common = round(share * 2 * n / (1 + share))
    left, right, exact = [], [], common / (2 * n - common)
    for _ in range(60):
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        left.append(pool[:n])
        right.append(pool[n - common : 2 * n - common])
    assert _agree(dm.signatures(left), dm.signatures(right)) == pytest.approx(exact, abs=0.03)


def test_weights_count():
    rng = np.random.default_rng(3)
    one, two, hits = np.array([2.5, 1, 0.5, 7]), np.array([1.5, 1, 3, 7]), []
    for _ in range(150):
        x = rng.integers(0, 2**63, 4).astype(np.uint64)
        hits.append(_agree(dm.signatures([x], [one]), dm.signatures([x], [two])))
    assert np.mean(hits) == pytest.approx(np.minimum(one, two).sum() / np.maximum(one, two).sum(), abs=0.03)


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 5, 300, 4000)]
    together = dm.signatures(sets)
    for i, s in enumerate(sets):
        assert (dm.signatures([s])[0] == together[i]).all()


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _brute(rows):
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = {i: _shingles(t) for i, t in rows}
    for a, b in itertools.combinations(sorted(parent), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.8 * len(x | y):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in parent}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    passage, texts = make(60), []
    for _ in range(30):
        base = make(rng.randint(80, 200))
        texts.append(base)
        for _ in range(rng.randint(0, 4)):  # chains: each is a change of the last
            base = list(base)
            for _ in range(2):
                base[rng.randrange(len(base))] = rng.choice(words)
            texts.append(base)
    texts += [make(25) + passage + make(25) for _ in range(40)]  # alike in a passage only
    hub = make(120)
    texts += [hub] * 40 + [[*hub[:60], rng.choice(words), *hub[60:]] for _ in range(60)]
    rows = [" ".join(t) for t in texts] + ["", None, "one", "one", "a b c d", "A  b c\nd", "   "]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_classes_against_all_pairs(spark, corpus):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in corpus], "doc_id long, text string, class_id string, n int").repartition(6)
    got = {r["doc_id"]: r["class_id"] for r in dm.classes(df).collect()}
    assert got == _brute(corpus)
    kept = dm.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_links_across_components_of_a_bucket(spark):
    """Members of one bucket that are not like its smallest member still find each other."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    near_b = b.replace("b99", "b")
    sh = dm.Shingler()
    sets = [(i, [int(x) for x in sh(t).view(np.int64)]) for i, t in enumerate([a, b, near_b, c])]
    shared = spark.createDataFrame([(1, i, len(s)) for i, s in sets], "bucket long, id long, n int")
    alone = spark.createDataFrame([], "node long, component long")
    got = dm._across(shared, alone, spark.createDataFrame(sets, "id long, shingles array<long>")).collect()
    assert [(r["a"], r["b"]) for r in got] == [(1, 2)]


def test_odd_rows(spark, tmp_path):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(5, text), (5, text), (None, text), (7, text + " x"), (8, None), (9, ""), (None, "other words"), (10, "z " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"]) for r in dm.classes(df).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (7, 5), (8, 8), (9, 9), (None, None), (10, 10)], key=str)
    kept = [r["doc_id"] for r in dm.keep_first(df).collect()]
    assert sorted(kept, key=str) == sorted([5, None, 8, 9, None, 10], key=str)
    df.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert dm.op7_near_duplicates(spark, str(tmp_path)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(500, i) for i in range(501, 900)] + [(i, i + 1) for i in range(1000, 1050)]
    parent = {}
    find = lambda i: i if parent.setdefault(i, i) == i else find(parent[i])
    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    df = spark.createDataFrame([*edges, (None, 3), (1, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {i: find(i) for a, b in edges for i in (a, b) if a != b}
