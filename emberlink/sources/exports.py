"""Bootstrap import of collection exports (JSON arrays, or one object per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from emberlink import schemas
from emberlink.functions.ids import natural_key
from emberlink.functions.times import parse_published
from emberlink.sources.canonical import canonical_article, conform
from emberlink.sources.json_arrays import parsed_elements, read_elements

# File of each exported collection.
EXPORT_FILES = {
    "news": "news.json",
    "wildfires": "fires.json",
    "landslides": "slides.json",
    "gnews": "gnews_articles.json",
}

_DATED = {T.TimestampType(), T.DateType()}
# Names that older writers used.
_RENAMED = {"publishedAt": "published_raw", "disaster_type": "linked_disaster_type", "timestamp": "ingested_at"}


def _raw_schema(schema: T.StructType, extra: list[str]) -> T.StructType:
    """Dates as text: exports hold them in several layouts."""
    fields = [
        T.StructField(f.name, T.StringType() if f.dataType in _DATED else f.dataType) for f in schema.fields
    ]
    fields += [T.StructField(name, T.StringType()) for name in extra]
    return T.StructType(fields + [T.StructField("_corrupt", T.StringType())])


def to_lines(spark: SparkSession, path: str, target: str, tasks: int | None = None) -> None:
    """Rewrite exports that are one JSON array per file as one object per line.

    The arrays are read in blocks, whatever their size; readers of lines then read them once instead of twice.
    Elements stay as they are; what is no object becomes a broken line.
    """
    whole = read_elements(spark, path)
    (whole.repartition(tasks) if tasks else whole).write.text(target)


def _read_raw(spark: SparkSession, path: str, schema: T.StructType, lines: bool, extra: list[str]) -> DataFrame:
    raw = _raw_schema(schema, extra)
    if not lines:
        return parsed_elements(spark, path, raw)
    return spark.read.schema(raw).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def export_rejects(spark: SparkSession, directory: str, lines: bool = False) -> DataFrame:
    """(``collection``, ``value``) of the export rows that :func:`load_exports` leaves out."""
    schemas_of = {"news": schemas.ARTICLES, "gnews": schemas.ARTICLES, "wildfires": schemas.WILDFIRES, "landslides": schemas.LANDSLIDES}
    found = None
    for name, schema in schemas_of.items():
        raw = _read_raw(spark, f"{directory.rstrip('/')}/{EXPORT_FILES[name]}", schema, lines, list(_RENAMED))
        # Spark reads the corrupt column alone only from what other columns have been read with.
        bad = raw.where(F.col("_corrupt").isNotNull()).select(F.lit(name).alias("collection"), F.col("_corrupt").alias("value"))
        found = bad if found is None else found.unionByName(bad)
    return found


def _read(spark: SparkSession, path: str, schema: T.StructType, lines: bool, extra: list[str]) -> DataFrame:
    raw = _read_raw(spark, path, schema, lines, extra).where(F.col("_corrupt").isNull())
    for old, new in _RENAMED.items():
        if old in extra and new in raw.columns:
            raw = raw.withColumn(new, F.coalesce(F.col(new), F.col(old)))
    if "published_raw" in raw.columns:
        raw = raw.withColumn("published_at", F.coalesce("published_at", "published_raw"))
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            raw = raw.withColumn(f.name, parse_published(F.col(f.name)))
        elif isinstance(f.dataType, T.DateType):
            raw = raw.withColumn(f.name, F.to_date(parse_published(F.col(f.name))))
    return raw


def load_exports(spark: SparkSession, directory: str, lines: bool = False) -> dict[str, DataFrame]:
    """``articles`` (both news collections), ``wildfires`` and ``landslides``."""
    at = {name: f"{directory.rstrip('/')}/{file}" for name, file in EXPORT_FILES.items()}
    old = list(_RENAMED)
    news = [
        canonical_article(_read(spark, at[name], schemas.ARTICLES, lines, old).drop("article_id"))
        for name in ("news", "gnews")
    ]
    fires = _read(spark, at["wildfires"], schemas.WILDFIRES, lines, ["timestamp"])
    key = natural_key("satellite", "acq_date", "acq_time", "latitude", "longitude")
    fires = fires.withColumn("fire_id", F.coalesce("fire_id", key))
    slides = _read(spark, at["landslides"], schemas.LANDSLIDES, lines, [])
    return {
        "articles": news[0].unionByName(news[1]),
        "wildfires": conform(fires, schemas.WILDFIRES),
        "landslides": conform(slides, schemas.LANDSLIDES),
    }
