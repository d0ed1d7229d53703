"""The stages one by one against plain versions, and as a whole on the given documents."""

import hashlib
import random
from pathlib import Path

import pytest

import corpus_pipeline
from emberlink.llm import dart_minhash, langid, packing, secrets, suffix_dedup
from tests.llm.test_near_duplicates import _brute as classes_of
from tests.llm.test_packing import _valid
from tests.llm.test_suffix_dedup import _brute as cut_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    tongues = {"aa": "bado fenu giko lapa mori".split(), "xx": "xyqz wxk zqyv kwyx vxqk".split()}
    make = lambda lang, n: " ".join(rng.choice(tongues[lang]) + rng.choice(tongues[lang]) + rng.choice(tongues[lang]) for _ in range(n))
    rows = []
    passage = make("aa", 40)
    for i in range(60):
        lang = "aa" if i % 2 else "xx"
        text = make(lang, rng.randint(60, 120))
        rows.append((text + (" " + passage if i % 7 == 0 else ""), lang))
        if i % 9 == 0:
            rows.append((text + " fin", lang))
            rows.append((text, lang))
    rows += [(f"{make('aa', 30)} password=abc{i}def9 {make('aa', 30)}", "aa") for i in range(5)]
    rows += [(None, None), ("", "aa"), ("12 34 - 56", "xx"), (None, "aa")]
    rng.shuffle(rows)
    return [(i, t, l, "hot" if i % 3 else "s", None if t is None else len(t)) for i, (t, l) in enumerate(rows)]


def test_stages_against_plain_versions(spark, corpus, tmp_path):
    docs = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    steps = dict(corpus_pipeline.STAGES)
    known = steps["language"](spark, docs, "")
    assert known.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in known.collect()}
    assert set(kept) == {i for i, t, *_ in corpus if t and any(c.isalpha() for c in t)}

    first = steps["near_duplicates"](spark, known, "")
    classes = classes_of(list(kept.items()))
    firsts = {i: kept[i] for i in classes if classes[i] == i}
    assert {r["doc_id"]: r["text"] for r in first.collect()} == firsts and first.columns == docs.columns

    cut = steps["repeated_text"](spark, first, "")
    rows = {r["doc_id"]: r for r in cut.collect()}
    for i, (_, _, _, digest) in cut_of(list(firsts.items())).items():
        assert hashlib.sha256(rows[i]["text"].encode()).hexdigest() == digest and rows[i]["n_chars"] == len(rows[i]["text"])
    assert set(rows) == set(firsts) and cut.columns == docs.columns

    masked = steps["secrets"](spark, cut, "")
    shown = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert set(shown) == set(rows) and masked.columns == docs.columns
    assert not any("password=abc" in t for t in shown.values())
    assert {i for i in shown if secrets.MASK in shown[i]} == {i for i in rows if "password=abc" in rows[i]["text"]}

    coder = packing.WordCoder(packing.read_vocabulary(), 2)
    plain = lambda text: list(memoryview(coder.encode([text])[0]).cast("I"))
    packed = steps["packing"](spark, masked, "").collect()
    _valid(packed, list(shown.items()), plain, 4096)

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(key, packed))


def test_odd_tables(spark):
    stages = corpus_pipeline.STAGES
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in stages:
        assert stage(spark, empty, "").count() == 0
    odd = spark.createDataFrame([(None, "some words in here", None, None, None, 1, "x"), (None, None, None, None, None, 2, "y")], SCHEMA + ", KEPT int, spans string")
    for _, stage in stages[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns
    assert stages[-1][1](spark, odd, "").count() == 2


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = langid.keep_known(docs)
    assert known.count() == docs.where("text rlike '\\\\p{L}'").count()
    firsts = dart_minhash.keep_first(known)
    cut = suffix_dedup.keep_unrepeated(firsts)
    assert cut.count() == firsts.count() == dart_minhash.classes(known).select("class_id").distinct().count()
