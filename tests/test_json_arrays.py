"""Arrays cut into blocks of a few bytes against Python's parser."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from emberlink.sources import exports, json_arrays as ja


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "61b", "spark.sql.files.openCostInBytes": "61b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


TRICKY = [
    {"a": "}{][,\"\\", "b": {"c": [1, {"d": "\\\\"}], "e": {}}}, {}, {"k": "x" * 300}, {"nested": {"deep": {"deeper": ["}", "]", "\\\"}"]}}},
    {"é": "日本 } \\u007d"}, {"empty": [], "list": [[], [{}], [{"q": '"'}]]}, {"n": None, "t": True, "f": -1.5e3}, {"tail": "ends with backslash \\"},
]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("turn", range(3))
def test_equal_to_the_parser(spark, tmp_path, small_blocks, indent, turn):
    rows = random.Random(turn).choices(TRICKY, k=60)
    (tmp_path / "a.json").write_text(("﻿" if turn == 1 else "") + json.dumps(rows, indent=indent, ensure_ascii=turn == 0) + "\n" * turn, encoding="utf-8")
    found = ja.read_elements(spark, str(tmp_path / "a.json"))
    assert ja._fragments(spark, str(tmp_path / "a.json")).rdd.getNumPartitions() > 8
    got = [r["value"] for r in found.collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(key(json.loads(v)) for v in got) == sorted(map(key, rows))
    assert not any("\n" in v for v in got)


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='ab"\\{}[],é ', max_size=6),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='k"}\\', max_size=3), x, max_size=3), max_leaves=8,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.text(max_size=3), VALUES, max_size=3), max_size=12))
def test_any_objects(spark, tmp_path, small_blocks, rows):
    (tmp_path / "any.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8", errors="replace")
    got = [json.loads(r["value"]) for r in ja.read_elements(spark, str(tmp_path / "any.json")).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, rows))


def test_odd_files(spark, tmp_path, small_blocks):
    def read(text):
        (tmp_path / "odd.json").write_text(text)
        return sorted(r["value"] for r in ja.read_elements(spark, str(tmp_path / "odd.json")).collect())

    assert read("") == read(" \n ") == read("[]") == read("[ \n ]") == []
    assert read('{"a": 1}\n{"b": {"c": 2}}\n') == ['{"a": 1}', '{"b": {"c": 2}}']
    assert read('[{"a": 1}, 17, {"b": 2}]') == ['17, {"b": 2}', '{"a": 1}']
    assert read('[{"a": 1}, {"b": "cut') [0].startswith('{"a": 1}') and len(read('[{"a": 1}, {"b": "cut')) == 2


def test_several_files_and_lines(spark, tmp_path, small_blocks):
    (tmp_path / "in").mkdir()
    for name, start in (("a", 0), ("b", 100)):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps([{"id": start + i, "t": "}" * (i % 5)} for i in range(40)], indent=1))
    exports.to_lines(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(r["id"] for r in got) == [*range(40), *range(100, 140)] and all(r["t"] == "}" * (r["id"] % 100 % 5) for r in got)


def test_one_large_element_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [{"a": 1}, {"big": ["}" * 50] * 60}, {"c": 3}]
    (tmp_path / "big.json").write_text(json.dumps(rows))
    got = [json.loads(r["value"]) for r in ja.read_elements(spark, str(tmp_path / "big.json")).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str) and {"big": ["}" * 50] * 60} in got
