"""Folders opened by their filters, against looking at the whole table."""

import pytest
from pyspark.sql import functions as F

from emberlink.operators.dedup import insert_absent
from emberlink.sinks import key_filters as kf
from emberlink.sinks.tables import append_absent, append_table, stored_keys


def _batch(spark, ids, note="n"):
    return spark.createDataFrame([(None if i is None else f"k{i}", i, note) for i in ids], "key string, n long, note string")


def test_only_folders_that_may_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    for start in range(0, 2000, 100):
        append_table(_batch(spark, range(start, start + 100)), path, key="key")
    names = lambda ids: kf.folders_to_open(spark, path, _batch(spark, ids), ["key"])
    assert len(names(range(0, 100))) == 1 and len(names([5, 150, 1999])) == 3
    assert len(names(range(5000, 5100))) == 0
    assert spark.read.parquet(path).count() == 2000  # the filters are no part of the table
    seen = stored_keys(spark, path, "parquet", _batch(spark, [5, 150]).select("key"))
    assert seen.count() == 200


@pytest.mark.parametrize("keys", ["key", ["key", "note"]])
def test_equal_to_the_anti_join(spark, tmp_path, keys):
    """Batches that overlap, with nulls, copies and empty ones; every table state equals the plain form's."""
    path, plain = str(tmp_path / "t"), None
    batches = [[1, 2, 3, None], [3, 4, 4, None], [], list(range(0, 60)), [100, 1, 101], [None]]
    for turn, ids in enumerate(batches):
        new = _batch(spark, ids, "a" if turn % 2 else "b")
        kept = insert_absent(new, plain if plain is not None else new.limit(0), keys, "n")
        kept = spark.createDataFrame(kept.collect(), new.schema)
        append_absent(new, path, keys, "n", as_of="2024-01-01")
        plain = kept if plain is None else plain.unionByName(kept)
        have = spark.read.parquet(path).select("key", "n", "note")
        assert sorted(map(repr, have.collect())) == sorted(map(repr, plain.collect()))


def test_rows_read_do_not_grow_with_the_table(spark, tmp_path):
    def read(folders):
        path = str(tmp_path / f"t{folders}")
        for i in range(folders):
            append_table(spark.range(i * 200, (i + 1) * 200).select(F.concat(F.lit("k"), "id").alias("key")), path, key="key")
        new = spark.range(3).select(F.concat(F.lit("k"), F.col("id") + 150).alias("key"))
        return stored_keys(spark, path, "parquet", new).count()

    assert read(2) == read(20) == 200


def test_a_folder_without_a_filter_is_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(_batch(spark, [1]), path)
    append_table(_batch(spark, [2]), path, key="key")
    append_table(_batch(spark, [3]), path, key="key")
    names = kf.folders_to_open(spark, path, _batch(spark, [2]), ["key"])
    assert len(names) == 2 and stored_keys(spark, path, "parquet", _batch(spark, [2]).select("key")).count() == 2


def test_share_of_false_finds(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 20_000 // kf.KEYS_PER_BLOCK
    bits = rows.select(kf._block(F.col("key"), F.lit(blocks)).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(kf._bits(F.col("key")))])
    words = bits.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(kf.WORDS)])
    asked = spark.range(10**6, 10**6 + 200_000).select(F.concat(F.lit("k"), "id").alias("key"))
    met = asked.select(kf._block(F.col("key"), F.lit(blocks)).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(kf._bits(F.col("key")))]).join(words, "block")
    assert met.where(" AND ".join(f"(w{i} & b{i}) = b{i}" for i in range(kf.WORDS))).count() <= 20
