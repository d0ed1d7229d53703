"""Large JSON arrays read by many tasks.

A file that is one array has no line breaks that a reader could trust. It is read as text that ends
at each ``}``, which Spark splits into blocks of bytes like any text. What a block means depends on all
before it: whether it begins inside a string, and how deep. So

1. each block tells, for both answers to the first question, how it ends and how much deeper it leads;
2. running over the blocks of a file (a few numbers each) gives each one's true beginning;
3. each block then cuts out its elements; what lies across blocks, two pieces a block at most, is put
   together by file and order.

Any file system that Spark reads will do. Elements are objects; they come as they are, but for line breaks
between their tokens, which become spaces. Objects one after another, without an array
around them, are read alike. Anything else between the elements (numbers, words, nested arrays) comes as text of
its own or in front of the object that follows it, for a parser to refuse: nothing is lost. A file that ends
within an element gives what is there. Blank files give nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

_END = "}"
_ESCAPE = re.compile(r"\\.", re.DOTALL)
_PLACE = ["file", "block"]


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``block``, ``value``), in the order of the file within each block."""
    text = spark.read.option("lineSep", _END).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _walk(fragment: str, inside: bool) -> tuple[bool, int]:
    """Whether a fragment ends inside a string, and how much deeper it leads; its final ``}`` does not count yet.

    A ``}`` never cuts an escape in two: after an odd number of backslashes it would be no JSON.
    """
    if "\\" in fragment:
        fragment = _ESCAPE.sub("", fragment)
    parts = fragment.split('"')
    outside = "".join(parts[1::2] if inside else parts[::2])
    depth = outside.count("{") + outside.count("[") - outside.count("]")
    return inside ^ (len(parts) % 2 == 0), depth


def _in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Runs of fragments of one block; a block may come in several runs, one after another."""
    for batch in batches:
        files, blocks, values = (batch[c].tolist() for c in (*_PLACE, "value"))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (files[i], blocks[i]) != (files[start], blocks[start]):
                yield (files[start], blocks[start]), values[start:i]
                start = i


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each run of a block: for a beginning outside and inside a string, the end and the depth gained."""
    for number, (place, values) in enumerate(_in_blocks(batches)):
        row = []
        for inside in (False, True):
            depth = 0
            for value in values:
                inside, more = _walk(value, inside)
                depth += more - (not inside)
            row += [inside, depth]
        yield pd.DataFrame([(*place, number, *row)], columns=[*_PLACE, "run", "end0", "depth0", "end1", "depth1"])


def _beginnings(fragments: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """How each block begins: inside a string, how deep, and how deep its file's elements lie. A few numbers for each block of a file."""
    runs = fragments.mapInPandas(_summaries, "file string, block long, run int, end0 boolean, depth0 long, end1 boolean, depth1 long")
    first = fragments.where("block = 0").groupBy("file").agg(F.first("value").alias("value"))
    arrays = {r["file"] for r in first.select("file", F.regexp_replace("value", "^[\\s﻿]+", "").startswith("[").alias("array")).where("array").collect()}
    found, last, inside, depth = {}, None, False, 0
    for r in sorted(runs.collect(), key=lambda r: (r["file"], r["block"], r["run"])):
        if r["file"] != last:
            last, inside, depth = r["file"], False, 0
        found.setdefault((r["file"], r["block"]), (inside, depth, int(r["file"] in arrays)))
        inside, depth = (r["end1"], depth + r["depth1"]) if inside else (r["end0"], depth + r["depth0"])
    return found


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of each element of the arrays at ``path``."""
    fragments = _fragments(spark, path)
    begin = spark.sparkContext.broadcast(_beginnings(fragments))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole elements (``piece`` 0), and what a block has of elements that begin before it (1) or go on behind it (2)."""
        place, held, base, whole = None, [], 0, False
        inside, depth = False, 0

        def rest() -> pd.DataFrame:
            # What closes the array, or what goes on in the next block.
            text = "".join(held)
            return pd.DataFrame([(*place, 2 if whole else 1, text)] if text.strip() else [], columns=[*_PLACE, "piece", "value"])

        for at, values in _in_blocks(batches):
            if at != place:
                if place is not None:
                    yield rest()
                place, held = at, []
                inside, depth, base = begin.value[at]
                whole = not inside and depth <= base  # else the block begins with the rest of an element
            out = []
            for value in values:
                inside, more = _walk(value, inside)
                depth += more - (not inside)
                held.append(value)
                held.append(_END)
                if not inside and depth <= base:
                    out.append((*at, 0 if whole else 1, "".join(held)))
                    held, whole = [], True
            yield pd.DataFrame(out, columns=[*_PLACE, "piece", "value"])
        if place is not None:
            yield rest()

    pieces = fragments.mapInPandas(cut, "file string, block long, piece int, value string")
    whole = pieces.where("piece = 0").select("value")
    # A rest that began before its block belongs to the last piece that went on behind its own.
    order = Window.partitionBy("file").orderBy("block", "piece")
    split = pieces.where("piece > 0").withColumn("element", F.sum((F.col("piece") == 2).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "value")))
    joined = split.groupBy("file", "element").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "").alias("value"))
    return _cleaned(whole.unionByName(joined.select("value")))


def _cleaned(elements: DataFrame) -> DataFrame:
    """Elements without what stands between them: commas, the array's brackets, a byte order mark, line breaks."""
    text = F.regexp_replace("value", "[\r\n]", " ")
    text = F.regexp_replace(text, "^[\\s﻿]*\\[?[\\s,]*", "")
    # Behind the last element, the array's end and the separator that the last fragment never had.
    text = F.regexp_replace(text, "^\\s*\\]?\\s*\\}?\\s*$", "")
    return elements.select(text.alias("value")).where(F.trim("value") != "")


def parsed_elements(spark: SparkSession, path: str, schema: T.StructType, corrupt: str = "_corrupt") -> DataFrame:
    """Elements in the columns of ``schema``; what cannot be parsed is whole in the column ``corrupt``."""
    body = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return read_elements(spark, path).select(body.alias("body")).select("body.*")
