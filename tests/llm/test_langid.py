"""The network's gradient, its pooling, and held-out accuracy on the given documents."""

from pathlib import Path

import numpy as np
import pytest

from emberlink.llm import langid

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, lang_pred string, SCORE int"


@pytest.fixture(scope="module")
def model():
    return langid.train({"aa": {b"aba": 5, b"baab": 2, b"ab": 1}, "xx": {b"xyx": 5, b"yyxx": 3, b"ab": 1}}, epochs=60)


def test_gradient_is_the_slope():
    w = {k: v.astype(np.float64) for k, v in langid._start(3).items()}
    grid, there = langid.pad([b"abc", b"xy", b"q"])
    target, weight = np.array([[1, 0, 0], [0, 0.5, 0.5], [0, 0, 1.0]]), np.array([1.0, 2.0, 0.5])
    _, g = langid.loss_and_gradient(w, grid, there, target, weight)
    rng = np.random.default_rng(0)
    for name in w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w[name].shape)
            if name == "embed":
                at = (ord(rng.choice(list("abcxyq"))), at[1])
            slope, step, kept = [], 1e-2, w[name][at]
            for sign in (1, -1):
                w[name][at] = kept + sign * step
                slope.append(langid.loss_and_gradient(w, grid, there, target, weight)[0])
            w[name][at] = kept
            assert (slope[0] - slope[1]) / (2 * step) == pytest.approx(g[name][at], abs=2e-4)


def test_pooling_is_the_mean_over_positions(model):
    text = "Aba, xyx; aba! " + "ab" * 50
    runs = [r.encode() for r in langid._LETTERS.findall(text.lower())]
    runs = [r[i : i + langid.LONGEST] for r in runs for i in range(0, len(r), langid.LONGEST)]
    p, there = langid.label_positions(model, runs)
    mean = p[there].mean(axis=0)
    languages, scores = langid.Labeller(model).label([text, None, "", "12 -- ..", "aba"])
    assert languages[0] == model.languages[int(mean.argmax())] and scores[0] == pytest.approx(mean.max(), abs=1e-4)
    assert languages[1:4] == ["und"] * 3 and list(scores[1:4]) == [0, 0, 0]
    assert languages[4] == "aa" and scores[4] > 0.8


def test_forgetting_changes_nothing(model, monkeypatch):
    texts = ["aba xyx", "yyxx", "baab ab"]
    want = langid.Labeller(model).label(texts)
    monkeypatch.setattr(langid, "REMEMBERED_BYTES", 1)
    again = langid.Labeller(model)
    got = [again.label([t]) for t in texts]
    assert [g[0][0] for g in got] == want[0]
    assert np.allclose([g[1][0] for g in got], want[1], atol=1e-5)


def test_tables(spark, tmp_path, model):
    rows = [(i, "aba baab ab " * 3, "aa", "kept", 1) for i in range(20)] + [(i, "xyx yyxx " * 3, "xx", "kept", 1) for i in range(20, 40)]
    rows += [(40, None, "aa", None, None), (41, "", None, None, None), (42, "12 34", "xx", None, None), (43, "xyx " * 20_000, None, None, None),
             (None, "aba", "aa", None, None), (20, "xyx yyxx " * 3, "xx", "kept", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = langid.op1_language(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["lang_pred"] == "aa" and by_id[43]["lang_pred"] == by_id[20]["lang_pred"] == "xx"
    assert [by_id[i]["lang_pred"] for i in (40, 41, 42)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = langid.keep_known(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    told = langid.predict(df, model, lang_col="LANG2", score_col="s")
    assert told.columns == [*df.columns, "LANG2", "s"]
    (tmp_path / "none").mkdir()
    df.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert langid.op1_language(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_noise_goes_and_documents_stay(spark):
    rng = np.random.default_rng(3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 10)))
    noise = spark.createDataFrame([(10**6 + i, " ".join(word() for _ in range(200)), None) for i in range(30)], docs.schema)
    kept = langid.keep_known(docs.unionByName(noise))
    assert kept.where("doc_id >= 1000000").count() <= 3
    assert kept.where("doc_id < 1000000").count() == docs.where("text rlike '\\\\p{L}'").count()


def test_long_runs_are_learned_as_they_are_read():
    """Runs without a gap that differ behind their first 32 bytes only."""
    same = b"a" * langid.LONGEST
    model = langid.train({"bb": {same + b"b" * 20: 5}, "cc": {same + b"c" * 20: 5}}, epochs=60)
    languages, scores = langid.Labeller(model).label(["a" * 32 + "b" * 20, "a" * 32 + "c" * 20])
    assert languages == ["bb", "cc"] and scores.min() > 0.6


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "aba", None, None, None)], SCHEMA)
    told = langid.predict(df.drop("lang_pred", "SCORE"), langid.train_on(df)).first()
    assert (told["lang_pred"], told["score"]) == ("und", 0.0)


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_held_out_accuracy(spark):
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in langid.op1_language(spark, SF).collect() if r["held_out"]]
    assert len(held) > 20
    assert np.mean([want[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.95
