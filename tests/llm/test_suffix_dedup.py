"""The merge, the anchors, and removal against brute force over every 100-byte string."""

from array import array
import hashlib
from pathlib import Path
import random
import re
import time

import numpy as np
import pandas as pd
import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from emberlink.llm import suffix_dedup as sd
from emberlink.llm.front_coding import LoserTree, common_prefix, decode_run, encode_run
from emberlink.session import shared_dir

STRINGS = st.lists(st.binary(max_size=6) | st.text(alphabet="ab", max_size=9).map(str.encode), max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(STRINGS, max_size=6))
def test_loser_tree_merges(runs):
    coded = [decode_run(encode_run(sorted(r))) for r in runs]
    assert [s for s, _ in coded] == [sorted(r) for r in runs]
    out = list(LoserTree(coded))
    assert [s for *_, s, _ in out] == sorted(s for r in runs for s in r)
    last = b""
    for run, at, string, shared in out:
        assert coded[run][0][at] == string and shared == common_prefix(last, string)
        last = string


def test_known_prefixes_are_not_compared():
    runs = [decode_run(encode_run([b"a" * 50 + bytes([i]) for i in range(k, 200, 4)])) for k in range(4)]
    tree = LoserTree(runs)
    assert len(list(tree)) == 200
    assert tree.compared <= 400  # and each looks past what is known


def _brute(rows):
    """rows: (doc_id, text) with different ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            window = raw[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    make = lambda n: " ".join(word() for _ in range(n))
    passages = [make(n) for n in (30, 60, 18, 200)]
    texts = []
    for _ in range(120):
        parts = [make(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 2)
            parts += [p[cut : len(p) - rng.randint(0, len(p) // 3)], make(rng.randint(0, 20))]
        texts.append(" ".join(parts))
    texts += [texts[3]] * 5 + [texts[4][:-1] + "x", "a" * 500, "b" + "a" * 300, "abc" * 150, "abcdefg" * 60 + "z" + "abcdefg" * 40]
    texts += [passages[1] + str(i) for i in range(40)] + ["x" * 99, "x" * 100, "x" * 101, "", None, "日本語" * 40, "本語日" * 40, make(4000)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def _got(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def _write(df, folder):
    df.write.parquet(str(folder / "documents.parquet"))
    return str(folder)


@pytest.mark.parametrize("kinds,run_bytes", [(256, 24_000_000), (3, 3_000)])
def test_against_brute_force(spark, corpus, tmp_path, monkeypatch, kinds, run_bytes):
    monkeypatch.setattr(sd, "KINDS", kinds)
    monkeypatch.setattr(sd.shared_windows, "__defaults__", (kinds,))
    monkeypatch.setattr(sd, "RUN_BYTES", run_bytes)
    monkeypatch.setattr(sd, "_TOGETHER", kinds)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in corpus], "doc_id long, text string, spans string, K1 int").repartition(7)
    assert _got(sd.op8_suffix_dedup(spark, _write(df, tmp_path))) == _brute(corpus)


def test_anchors_of_equal_windows_are_equal():
    rng = np.random.default_rng(0)
    shared = rng.integers(97, 101, 400).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), shared])
    b = np.concatenate([shared, rng.integers(97, 101, 77).astype(np.uint8)])
    found = sd.anchors([a.tobytes(), b"x" * 99, b"", b.tobytes()])
    of = lambda k: {i: g for o, g, lo, hi in zip(*found) if o == k for i in range(lo, hi + 1)}
    left, right = of(0), of(3)
    assert set(found[0]) == {0, 3}
    assert len(left) == len(a) - 99
    assert all(left[333 + i] == right[i] for i in range(301))


def test_odd_rows(spark, tmp_path):
    text = "some words that are long enough " * 6
    rows = [(1, text, 5), (None, text, 5), (1, text, 5), (2, None, 0), (3, "", 0), (4, "short", 5), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = [(r["doc_id"], r["n_removed"]) for r in sd.remove(df).collect()]
    n = len(text)
    own = n - 32  # the text repeats itself from its second line on
    assert sorted(got, key=str) == sorted([(1, own), (1, own), (None, n), (2, 0), (3, 0), (4, 0), (None, 0)], key=str)
    cut = sd.keep_unrepeated(df)
    assert cut.columns == df.columns and cut.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert sorted((str(r["doc_id"]), r["text"], r["n_chars"]) for r in cut.where("text <> ''").collect()) == [("1", text[:32], 32)] * 2 + [("4", "short", 5)]
    assert sd.op8_suffix_dedup(spark, _write(df.where("false"), tmp_path)).count() == 0


def test_repeats_of_a_task_do_not_meet():
    hot, tasks, n = b"x" * 150, 4, 2 * sd._PIECE + 10
    held = [{hot: [(t * n + i, 5, 7, 99) for i in reversed(range(n))], bytes([65 + t]) * 120: [(t, 6, 0, 98)]} for t in range(tasks)]
    sent = pd.concat([sd._segment_run(h, 8) for h in held], ignore_index=True)
    merged = sent[sent["run"].notna()]
    assert sum(len(zstandard.decompress(p)) for p in merged["places"]) == 2 * tasks * sd._PLACE.itemsize  # one place a string and run
    assert max(len(zstandard.decompress(p)) for p in sent["places"]) <= sd._PIECE * sd._REPEAT.itemsize
    out = pd.concat([sd._merge_bucket(g) for _, g in sent.groupby("bucket")], ignore_index=True)
    kinds = out[out["segment"].notna()]
    assert sorted(zip(kinds["segment"], kinds["k1"], kinds["gram"])) == sorted([(hot, 0, 99)] + [(bytes([65 + t]) * 120, t, 98) for t in range(tasks)])
    rest = out[out["segment"].isna()]
    assert sorted(rest["k1"]) == list(range(1, tasks * n)) and set(rest["size"]) == {150} and set(rest["start"]) == {7}


def test_places_as_plain_numbers_make_the_same_runs():
    held = {b"a" * 120: [(3, 1, 0, 9), (2, 1, 4, 9), (2, 1, 1, 9)], b"b" * 130: [(1, 1, 7, -8)]}
    plain = {s: array("q", [x for p in places for x in p]) for s, places in held.items()}
    one, other = (sd._merge_bucket(sd._segment_run(h, 1).query("bucket == 0")) for h in (held, plain))
    assert one.equals(other) and sorted(zip(one["k1"], one["start"], one["gram"])) == [(1, 7, -8), (2, 1, 9)]
    left = sd._merge_bucket(sd._segment_run(plain, 1).query("bucket == 1"))
    assert list(zip(left["k1"], left["start"], left["size"])) == [(2, 4, 120), (3, 0, 120)]


def test_repeats_of_a_document_that_touch_are_one():
    rows = [(1, 1, 0, 120), (1, 1, 220, 100), (1, 1, 120, 100), (1, 1, 30, 10), (1, 1, 321, 100), (1, 2, 300, 100), (-4, 7, 2**31 - 101, 100), (0, 7, 0, 100)]
    joined = sd._joined(np.array(rows, sd._REPEAT)).tolist()
    assert joined == [(-4, 7, 2**31 - 101, 100), (0, 7, 0, 100), (1, 1, 0, 320), (1, 1, 321, 100), (1, 2, 300, 100)]
    held = {bytes([97 + i]) * 150: [(1, 1, 900, 5), (2, 1, 40 * i, 5)] for i in range(5)}
    left = sd._merge_bucket(sd._segment_run(held, 1).query("bucket == 1"))
    assert list(zip(left["k1"], left["start"], left["size"])) == [(2, 0, 310)]


def test_only_spans_stay_on_disk(spark, corpus, tmp_path):
    """Tables and shuffles of a step go once the next has been written."""
    files = lambda: set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").split(","))
    shared = Path(shared_dir(spark).removeprefix("file:"))
    spark.createDataFrame(corpus, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    stays, before = set(shared.iterdir()), files()
    found = sd.repeated_spans(spark.read.parquet(str(tmp_path / "docs")))
    assert [p.name.split("-")[:2] for p in set(shared.iterdir()) - stays] == [["suffix", "spans"]]
    shuffles = lambda: {m[1] for f in files() - before if (m := re.search(r"shuffle_(\d+)_\d+_\d+\.data", f))}
    until = time.time() + 10
    while len(shuffles()) > 1 and time.time() < until:
        time.sleep(0.1)
    assert len(shuffles()) <= 1  # the sum of sizes is a query of its own
    assert found.count() > 50
