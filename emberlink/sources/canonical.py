"""The one article shape that every source ends in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from emberlink import schemas
from emberlink.functions.ids import article_key
from emberlink.functions.times import as_timestamp


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null, others cast, extra ones dropped."""
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def canonical_article(df: DataFrame, source_type: str | None = None, as_of=None) -> DataFrame:
    """One source's articles in canonical shape, with their id and the time of ingestion."""
    if source_type is not None:
        df = df.withColumn("source_type", F.lit(source_type))
    for column in ("url", "title", "source"):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    if "article_id" not in df.columns:
        df = df.withColumn("article_id", article_key())
    if as_of is not None:
        df = df.withColumn("ingested_at", as_timestamp(as_of))
    return conform(df, schemas.ARTICLES)


def canonical_union(*frames: DataFrame, as_of=None) -> DataFrame:
    """All sources as one collection."""
    return reduce(DataFrame.unionByName, [canonical_article(f, as_of=as_of) for f in frames])
