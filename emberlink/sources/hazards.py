"""Readers for hazard data: satellite fire detections and the landslide catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from emberlink import schemas
from emberlink.functions.ids import natural_key
from emberlink.functions.text import blank_to_null
from emberlink.functions.times import as_timestamp, parse_published
from emberlink.sources.json_arrays import parsed_elements

DEFAULT_COUNTRY = "DEU"


def firms_fires(raw: DataFrame, as_of) -> DataFrame:
    """Detections as ``wildfires``. The default country is for files without that column."""
    country = F.col("country_id") if "country_id" in raw.columns else F.lit(DEFAULT_COUNTRY)
    fires = raw.select(
        country.alias("country"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("bright_ti4").cast("double").alias("brightness"),
        "confidence",
        F.col("acq_date").try_cast("date").alias("acq_date"),
        F.lpad("acq_time", 4, "0").alias("acq_time"),
        "satellite",
        "instrument",
        F.col("frp").cast("double").alias("frp"),
        "daynight",
        F.lit("NASA_FIRMS").alias("source"),
        as_timestamp(as_of).alias("ingested_at"),
    )
    key = natural_key("satellite", "acq_date", "acq_time", "latitude", "longitude")
    return fires.select(key.alias("fire_id"), *fires.columns)


def read_firms_raw(spark: SparkSession, path: str) -> DataFrame:
    """Detections as text, whatever columns each file has and in whatever order.

    A file's first line is its header, and decides its columns; files with one header are read
    together. Columns that the model knows and a file lacks are null (``country_id``: the default, if other
    files have it); a row with too few or too many fields is whole in ``_corrupt``.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    first = lines.where("block = 0").groupBy("file").agg(F.first("value").alias("header"))
    # As many as there are layouts, not files.
    layouts = [r["header"] for r in first.select("header").distinct().collect()]
    rows = lines.join(first, "file").where("value <> header and trim(value) <> ''")
    named = {h: [c.strip().strip('"').lower() for c in h.lstrip("\ufeff").split(",")] for h in layouts}
    names = [f.name for f in schemas.FIRMS_ROW.fields if f.name != "country_id" or any("country_id" in n for n in named.values())]
    found = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_corrupt"]]))
    for header, columns in named.items():
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))]
        schema = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
        parsed = F.from_csv("value", schema.simpleString()[len("struct<") : -1].replace(":", " "), {"columnNameOfCorruptRecord": "_corrupt"})
        at = {c: f"row.c{i}" for i, c in reversed(list(enumerate(columns)))}
        lacking = {"country_id": F.lit(DEFAULT_COUNTRY)}
        picked = [F.col(at[n]).alias(n) if n in at else lacking.get(n, F.lit(None).cast("string")).alias(n) for n in names]
        mine = rows.where(F.col("header") == header).select(parsed.alias("row"))
        found = found.unionByName(mine.select(*picked, "row._corrupt"))
    return found


def _unreadable(raw: DataFrame, kinds: dict[str, str]) -> Column:
    """What is wrong with a row: broken, or a value that is there and not of its kind; else null."""
    wrong = [F.when(blank_to_null(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(c)) for c, kind in kinds.items()]
    broken = F.when(F.col("_corrupt").isNotNull(), F.lit("broken")) if "_corrupt" in raw.columns else F.lit(None).cast("string")
    return F.coalesce(broken, *wrong)


_FIRMS_KINDS = {"latitude": "double", "longitude": "double", "bright_ti4": "double", "frp": "double", "acq_date": "date"}
_SLIDE_KINDS = {"latitude": "double", "longitude": "double"}


def split_firms(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to load, and rows to look at with a ``reason``."""
    judged = raw.withColumn("reason", _unreadable(raw, _FIRMS_KINDS))
    return judged.where("reason is null").drop("reason", "_corrupt"), judged.where("reason is not null")


def read_firms_csv(spark: SparkSession, path: str, as_of) -> DataFrame:
    """Detections that can be read; :func:`split_firms` of :func:`read_firms_raw` has the others, too."""
    return firms_fires(split_firms(read_firms_raw(spark, path))[0], as_of)


def landslide_rejects(raw: DataFrame) -> DataFrame:
    """Catalog rows that :func:`landslide_events` leaves out, with a ``reason``."""
    missing = [F.when(blank_to_null(c).isNull(), F.concat(F.lit("no "), F.lit(c))) for c in ("event_id", "latitude", "longitude")]
    return raw.withColumn("reason", F.coalesce(_unreadable(raw, _SLIDE_KINDS), *missing)).where("reason is not null")


def landslide_events(raw: DataFrame, as_of) -> DataFrame:
    """Catalog rows with an id and a place. A value that is no number drops its own row only."""
    rows = raw.where(F.col("_corrupt").isNull()) if "_corrupt" in raw.columns else raw
    number = lambda c: blank_to_null(c).try_cast("double")
    placed = rows.where(blank_to_null("event_id").isNotNull()).select(
        F.lit("landslide").alias("type"),
        "event_id",
        "location",
        F.to_date(parse_published(F.col("date"))).alias("date"),
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
        "source_name",
        "fatality_count",
        "landslide_size",
        "trigger",
        as_timestamp(as_of).alias("created_at"),
    )
    return placed.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def read_landslides_raw(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The catalog as one JSON array per file, read in blocks, or one object per line."""
    if not lines:
        return parsed_elements(spark, path, schemas.LANDSLIDE_ROW)
    return spark.read.schema(schemas.LANDSLIDE_ROW).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_landslides(spark: SparkSession, path: str, as_of, lines: bool = False) -> DataFrame:
    return landslide_events(read_landslides_raw(spark, path, lines), as_of)
