import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from emberlink import schemas
from emberlink.operators import tagger
from emberlink.operators.entities import extract_entities

NAMES = {"LOC": ["Bern", "Upper Wallis", "Hessen", "Alps", "Saarland", "Berlin"], "ORG": ["Polizei", "NASA", "Feuerwehr", "Red Cross"]}
UNKNOWN = {"LOC": ["Tirol", "Lower Kaernten", "Opole"], "ORG": ["Rega", "Interpol"]}


def texts(names, n, seed):
    rng = random.Random(seed)
    forms = [
        "A fire near {LOC} was put out", "Many homes in {LOC} had smoke", "On Monday {ORG} said that the road is shut",
        "Help came when {ORG} said so near {LOC} today", "Strong wind was seen in {LOC} by night", "Later {ORG} said that all is well",
    ]
    return [rng.choice(forms).format(LOC=rng.choice(names["LOC"]), ORG=rng.choice(names["ORG"])) + f" on day {i}." for i in range(n)]


def test_best_paths_equal_all_paths():
    rng = np.random.default_rng(2)
    tags = tagger.Tags({"A": [], "B": []})
    lengths = np.array([1, 2, 3, 4, 4])
    # Small whole numbers, so that ties occur.
    scores = rng.integers(-2, 3, (5, 4, tags.count)).astype(float)
    steps = rng.integers(-1, 2, (tags.count + 1, tags.count)) + tags.barred
    for s, (path, length) in enumerate(zip(tagger.best_paths(scores, lengths, steps), lengths)):
        def worth(p, s=s):
            ways = [steps[-1, p[0]]] + [steps[a, b] for a, b in zip(p, p[1:])]
            return sum(ways) + sum(scores[s, i, t] for i, t in enumerate(p))

        every = list(itertools.product(range(tags.count), repeat=int(length)))
        best = max(map(worth, every))
        # Of the best paths, the lowest tags from the end on.
        assert tuple(path[:length]) == min((p for p in every if worth(p) == best), key=lambda p: p[::-1])


def test_many_sentences_at_once_equal_one_at_a_time():
    tags = tagger.Tags(NAMES)
    weights = np.random.default_rng(1).integers(-3, 4, (tagger.ROWS + tags.count + 1, tags.count)).astype(float)
    sentences = [[w[0] for w in s] for t in texts(NAMES, 40, 3) for s in tagger.split_words(t)] + [[], ["x"], ["y"] * 150]
    for words, path in zip(sentences, tagger._decode(sentences, weights, tags.barred)):
        assert len(path) == len(words)
        if words:
            scores = np.stack([weights[r].sum(axis=0) for r in tagger.features(words)])
            alone = tagger.best_paths(scores[None], np.array([len(words)]), weights[tagger.ROWS :] + tags.barred)[0]
            assert list(alone) == list(path)
            last = 0
            for tag in path:  # inside follows begin or inside of its label
                assert tag == 0 or tag % 2 or last in (tag, tag - 1)
                last = tag


def test_known_names_and_windows():
    tags = tagger.Tags({"LOC": ["Alps", "High Alps"], "ORG": ["Red Cross"]})
    words = ["The", "High", "Alps", "Alps", "Red", "Cross", "Red"]
    assert list(tags.known(words)) == [0, 1, 2, 1, 3, 4, 0]
    assert tags.spans(tags.known(words)) == [(1, 3, 0), (3, 4, 0), (4, 6, 1)]
    long = "word " * 450 + "end. Next one."
    assert [len(s) for s in tagger.split_words(long)] == [200, 200, 52, 3]
    assert all(long[a:b] == w for s in tagger.split_words(long) for w, a, b in s)


@pytest.fixture(scope="module")
def learned(spark):
    df = spark.createDataFrame([(t,) for t in texts(NAMES, 900, 7)] + [(None,), ("",)], "body string").cache()
    return df, tagger.train(df, "body", NAMES, rounds=3, shards=3)


def test_held_out_names_are_found(learned):
    df, weights = learned
    scores = {r.label: r for r in tagger.held_out_scores(df, "body", weights, NAMES).collect()}
    assert set(scores) == {"LOC", "ORG"}
    assert all(r.names > 20 and r.f1 >= 0.95 for r in scores.values())


def test_names_that_the_gazetteer_lacks(spark, learned):
    _, weights = learned
    rows = texts(UNKNOWN, 60, 9)
    make = tagger.make_tagger(weights, NAMES)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(rows)] + [(-1, None, 1), (-2, "", 1), (-3, rows[0], None)], "id int, body string, linked_fire_id int")
    df = df.withColumn("entities", F.lit(None).cast(T.ArrayType(schemas.ENTITY)))
    got = {r.id: r.entities for r in extract_entities(df, "body", NAMES, make_tagger=make).collect()}
    assert got[-1] == [] and got[-2] == [] and got[-3] is None
    hits = wanted = wrong = 0
    for i, text in enumerate(rows):
        want = {(n, k) for k, names in UNKNOWN.items() for n in names if n in text}
        have = {(e.text, e.label) for e in got[i]}
        hits, wanted, wrong = hits + len(want & have), wanted + len(want), wrong + len(have - want)
    assert hits >= 0.8 * wanted and wrong <= 0.2 * wanted


def test_known_names_keep_their_label(learned):
    _, weights = learned
    (found,) = tagger.make_tagger(weights, NAMES)()(["Snow near NASA and the Upper Wallis"])
    assert ("NASA", "ORG") in found and ("Upper Wallis", "LOC") in found


def test_training_without_a_name(spark):
    df = spark.createDataFrame([("nothing here",), (None,)], "body string")
    weights = tagger.train(df, "body", NAMES)
    assert not weights.any()
    assert tagger.make_tagger(weights, NAMES)()(["still nothing", "", "Bern"]) == [[], [], [("Bern", "LOC")]]


def test_training_does_not_depend_on_the_order_of_rows(spark):
    rows = [(t,) for t in texts(NAMES, 80, 4)]
    one = tagger.train(spark.createDataFrame(rows, "body string"), "body", NAMES, rounds=2)
    other = tagger.train(spark.createDataFrame(rows[::-1] * 2, "body string").repartition(5), "body", NAMES, rounds=2)
    assert np.array_equal(one, other)


def test_words_keep_their_scores_between_batches():
    rng = np.random.default_rng(2)
    weights = rng.standard_normal((tagger.ROWS + 4, 3))
    adds = tagger.Adds(weights)
    adds.know([["one", "Two", "one"]])
    before = [t.copy() for t in adds.tables]
    adds.know([["Two", "three"]])
    assert adds.ids == {"": 0, "one": 1, "Two": 2, "three": 3}
    for (place, _), table, old in zip(tagger._PLACES, adds.tables, before):
        assert np.array_equal(table[:3], old)
        for word, no in adds.ids.items():
            rows = tagger._around(word, place) if place else tagger._own(word)
            assert np.allclose(table[no], weights[rows].sum(axis=0), atol=1e-12)


def _one_at_a_time(weights, sentences, tags):
    """The perceptron as it is defined: each window is tagged with the weights that the one before it left."""
    w, total, seen = weights.copy(), np.zeros_like(weights), 0
    for words in (([t[0] for t in tokens]) for s in sentences for tokens in tagger.split_words(s) if tokens):
        rows, want = tagger.features(words), tags.known(words)
        scores = np.stack([w[r].sum(axis=0) for r in rows])
        have = tagger.best_paths(scores[None], np.array([len(words)]), w[tagger.ROWS :] + tags.barred)[0]
        for i, (good, bad) in enumerate(zip(want, have)):
            if good != bad:
                np.add.at(w[:, good], rows[i], 1)
                np.add.at(w[:, bad], rows[i], -1)
            w[tagger.ROWS + (want[i - 1] if i else tags.count), good] += 1
            w[tagger.ROWS + (have[i - 1] if i else tags.count), bad] -= 1
        total += w
        seen += 1
    return w, total / seen


def test_a_pass_that_looks_ahead_equals_one_sentence_at_a_time():
    tags = tagger.Tags(NAMES)
    sentences = texts(NAMES, 200, 11) + ["Bern " + "and so on " * 150 + "to Upper Wallis", "Bern", "!"]
    shard = tagger.Shard.of(sentences, tags, 2)
    weights = np.zeros((tagger.ROWS + tags.count + 1, tags.count))
    for turn in range(2):
        order = sorted(sentences, key=lambda s: (tagger.zlib.crc32(f"{turn}:{s}".encode()), s))
        last, mean = tagger._pass(weights, *shard.turn(turn), tags)
        want_last, want_mean = _one_at_a_time(weights, order, tags)
        assert np.array_equal(last, want_last) and np.allclose(mean, want_mean, atol=1e-9)
        weights = last


def test_every_sentence_takes_part_in_training(spark, monkeypatch):
    counted, average = [], tagger._average
    monkeypatch.setattr(tagger, "_average", lambda parts: counted.append(average(parts)[0]) or average(parts))
    rows = [(f"Near Bern {i}",) for i in range(8_300)] + [("Smoke " * 600 + "in Bern",), (None,), ("",)]
    df = spark.createDataFrame(rows + rows[:50], "body string")
    tagger.train(df, "body", NAMES, rounds=1, whole=True)
    held_out = tagger.sentences_with_names(df, "body", NAMES).where("held_out").count()
    tagger.train(df, "body", NAMES, rounds=1)
    assert counted == [8_301, 8_301 - held_out] and held_out > 0


def test_a_long_sentence_is_learned(spark):
    """Two sentences of over 2000 characters, nothing else."""
    df = spark.createDataFrame([("They said " * 300 + "in Bern",), ("We came " * 400 + "to the Red Cross",)], "body string")
    assert tagger.train(df, "body", NAMES, rounds=1, whole=True).any()


def test_shards_grow_in_number_and_merge_in_groups(spark, monkeypatch):
    monkeypatch.setattr(tagger, "SHARD", 400)
    df = spark.createDataFrame([(t,) for t in texts(NAMES, 300, 7)], "body string")
    weights = tagger.train(df, "body", NAMES, rounds=4, shards=1)
    scores = {r.label: r for r in tagger.held_out_scores(df, "body", weights, NAMES).collect()}
    assert all(r.f1 >= 0.9 for r in scores.values())
