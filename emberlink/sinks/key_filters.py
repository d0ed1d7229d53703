"""Bloom filters beside a table's folders, so that a batch opens only the folders that may hold its keys.

A filter is a small Parquet file, ``_keys/writer=W/batch_id=N`` below the table (Spark leaves names with an underscore
out when it reads the table). It has a power of two of blocks of 512 bits, eight words each; a key has one
block and one bit in each of its words. With some ``KEYS_PER_BLOCK`` keys a block, four bytes a key, one key in
160,000 that a folder does not hold is taken for one that it may hold, and then costs a look. No key
that it holds is ever missed. A batch's keys meet the filters in an equi-join on (number of blocks, block).

A filter is made from the folder as it was written, and the old one goes before a folder is written
anew: a folder without a filter, such as one whose writer stopped in between, is simply opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS_PER_BLOCK = 16
WORDS = 8
_PLACE = ["writer", "batch_id"]


def whole_key(keys: Sequence[str]) -> Column:
    """One text for the columns of a key, never null."""
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _bits(key: Column) -> list[Column]:
    """The bit of a key in each word of its block."""
    spread = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(spread, 6 * i) % 64).cast("int")) for i in range(WORDS)]


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _beside(path: str, writer: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/_keys/writer={writer}/batch_id={batch_id}"


def drop_filter(spark: SparkSession, path: str, writer: str, batch_id: int) -> None:
    files, place = _fs(spark, _beside(path, writer, batch_id))
    files.delete(place, True)


def write_filter(stored: DataFrame, path: str, writer: str, batch_id: int, keys: Sequence[str]) -> None:
    """The filter of one folder, whose rows are ``stored``."""
    rows = stored.select(whole_key(keys).alias("key"))
    blocks = 1
    while blocks * KEYS_PER_BLOCK < rows.count():
        blocks *= 2
    words = [F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]
    bits = rows.select(_block(F.col("key"), F.lit(blocks)).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col("key")))])
    filled = bits.groupBy("block").agg(*words).withColumn("blocks", F.lit(blocks).cast("long"))
    filled.write.mode("overwrite").parquet(_beside(path, writer, batch_id))


def _folders(spark: SparkSession, path: str, below: str = "") -> set[tuple[str, str]]:
    files, place = _fs(spark, f"{path.rstrip('/')}{below}/writer=*/batch_id=*")
    found = files.globStatus(place) or []
    return {(f.getPath().getParent().getName().split("=", 1)[1], f.getPath().getName().split("=", 1)[1]) for f in found}


def folders_to_open(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str]) -> list[str]:
    """Folders of the table that may hold a key of ``new``: a name for each, no keys."""
    held, filtered = _folders(spark, path), _folders(spark, path, "/_keys")
    hit = held - filtered
    if held & filtered:
        schema = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS)) + ", blocks long, writer string, batch_id string"
        filters = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/_keys")
        sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]  # powers of two
        key = F.col("key")
        asked = new.select(whole_key(keys).alias("key")).distinct().select("key", *[b.alias(f"b{i}") for i, b in enumerate(_bits(key))])
        asked = asked.withColumn("blocks", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes] or [F.lit(1).cast("long")])))
        met = asked.withColumn("block", _block(key, F.col("blocks"))).join(filters, ["blocks", "block"])
        for i in range(WORDS):
            met = met.where(F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) == F.col(f"b{i}"))
        hit |= {(r["writer"], r["batch_id"]) for r in met.select(*_PLACE).distinct().collect()} & held
    return [f"{path.rstrip('/')}/writer={w}/batch_id={b}" for w, b in sorted(hit)]
