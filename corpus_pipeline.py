"""From ``documents`` to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last
return the columns of ``documents``.

1. ``language``: documents whose language the network cannot tell go.
2. ``near_duplicates``: one document of each class of near-duplicates stays, the one with the smallest id.
3. ``repeated_text``: text that starts earlier in 100 bytes or more is cut out; all documents stay.
4. ``secrets``: secrets are masked; all documents stay.
5. ``packing``: pieces of documents and their places in sequences of at most 4096 ids.

Null and empty texts, and texts without a letter, go in the first stage; null ids stay throughout. Very long texts are
read whole by every stage. Of repeated rows, and of ties, the second stage keeps one. Empty tables
pass through, and columns beyond those of ``documents`` are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberlink.llm import dart_minhash, langid, packing, secrets, suffix_dedup
from emberlink.llm.common import cut_lineage, table
from emberlink.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dart_minhash.keep_first(docs)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.keep_unrepeated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, packing.read_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_text", repeated_text),
    ("secrets", secret_scan),
    ("packing", packed),
]

#: A trained network and a tokenizer have no SQL form; tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
