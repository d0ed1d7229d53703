"""The given tables in the roles of articles, fires, landslides and vectors.

The tables hold no disaster words and no coordinates. Word lists made of fragments that occur in
the texts, and points computed from row ids, stand in for them. Each role has a DataFrame form
and the same thing as a SQL subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2024-01-31"

# Fragments that occur in the texts, in the place of disaster keywords and place names.
TYPES = {
    "wildfire": ["anble", "ingre", "ersch"],
    "landslide": ["edtion", "heing", "enheit"],
}
PLACES = ["berg", "eding", "enlich"]
PRIORITY = ["Berg", "Eding", "The"]

# Boxes in the place of dashboard regions: name, south, north, west, east.
REGIONS = [
    ("Alpine", 47.0, 48.5, 6.0, 11.0),
    ("Rhine", 48.5, 51.0, 6.0, 9.0),
    ("Danube", 48.5, 50.0, 9.0, 14.0),
    ("North", 52.5, 55.0, 6.0, 14.0),
]

# Outlines in the place of region polygons, as rings of (latitude, longitude): one with a hole, one in two parts, one that overlaps.
OUTLINES = [
    ("Alps", [
        [(47.1, 6.2), (47.05, 9.7), (48.9, 12.3), (49.6, 9.1), (48.75, 6.6)],
        [(47.9, 8.1), (48.6, 8.3), (48.3, 9.6), (47.75, 9.05)],
    ]),
    ("Isles", [[(52.0, 7.0), (53.4, 7.7), (52.9, 9.2), (51.7, 8.8)], [(53.1, 11.0), (54.6, 11.6), (53.8, 13.9)]]),
    ("Middle", [[(48.0, 8.0), (53.0, 8.0), (50.5, 14.4), (50.0, 10.0)]]),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(base: float, factor: int, cells: int) -> Column:
    return F.lit(base) + ((F.col("event_id") * factor) % cells) / F.lit(100.0)


def _spread_sql(base: float, factor: int, cells: int) -> str:
    return f"({base}::DOUBLE + ((event_id * {factor}) % {cells}) / 100.0::DOUBLE)"


# ---- events: news items with a place, fire detections, landslides ------------------------


def placed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("view", "click", "purchase"))
        .select(
            F.col("event_id").alias("article_id"),
            F.col("ts").alias("published_at"),
            _spread(47.0, 1, 800).alias("query_lat"),
            _spread(6.0, 7, 900).alias("query_lon"),
            (F.col("value") / F.lit(100.0)).alias("semantic_score"),
        )
    )


PLACED_ARTICLES_SQL = f"""(
    SELECT event_id AS article_id, ts AS published_at,
           {_spread_sql(47.0, 1, 800)} AS query_lat, {_spread_sql(6.0, 7, 900)} AS query_lon,
           value / 100.0::DOUBLE AS semantic_score
    FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""


def wildfires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .select(
            F.col("event_id").alias("fire_id"),
            _spread(47.0, 13, 800).alias("latitude"),
            _spread(6.0, 31, 900).alias("longitude"),
            F.to_date("ts").alias("acq_date"),
            F.date_format("ts", "HHmm").alias("acq_time"),
            F.col("value").alias("frp"),
        )
    )


WILDFIRES_SQL = f"""(
    SELECT event_id AS fire_id, {_spread_sql(47.0, 13, 800)} AS latitude,
           {_spread_sql(6.0, 31, 900)} AS longitude, ts::DATE AS acq_date,
           strftime(ts, '%H%M') AS acq_time, value AS frp
    FROM events WHERE event_type = 'error')"""


def landslides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'signup'")
        .select(
            "event_id",
            _spread(47.0, 13, 800).alias("latitude"),
            _spread(6.0, 31, 900).alias("longitude"),
            F.to_date("ts").alias("date"),
        )
    )


LANDSLIDES_SQL = f"""(
    SELECT event_id, {_spread_sql(47.0, 13, 800)} AS latitude,
           {_spread_sql(6.0, 31, 900)} AS longitude, ts::DATE AS date
    FROM events WHERE event_type = 'signup')"""

HAZARDS_SQL = f"""(
    SELECT fire_id AS hazard_id, 'wildfire' AS disaster_type, latitude, longitude, acq_date AS event_date
    FROM {WILDFIRES_SQL} AS w
    UNION ALL
    SELECT event_id AS hazard_id, 'landslide' AS disaster_type, latitude, longitude, date AS event_date
    FROM {LANDSLIDES_SQL} AS l)"""


# ---- documents: news items with text ------------------------------------------------------


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts share a url; ids grow in store order."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"),
        F.col("source").alias("title"),
        F.col("text").alias("description"),
        F.concat(F.lit("https://news.example/"), F.md5(F.lower(F.trim("text")))).alias("url"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("doc_id") % 30).cast("int"))).alias("published_at"),
        "source",
        F.col("lang").alias("language"),
        F.upper("lang").alias("country"),
    )


ARTICLES_SQL = """(
    SELECT doc_id AS article_id, source AS title, text AS description,
           'https://news.example/' || md5(lower(trim(text))) AS url,
           TIMESTAMP '2024-01-01 00:00:00' + to_days((doc_id % 30)::INTEGER) AS published_at,
           source, lang AS language, upper(lang) AS country
    FROM documents)"""


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of which some carry results of earlier enrichment, taken from ``labels``."""
    labels = table(spark, sf_dir, "labels")
    joined = articles(spark, sf_dir).join(labels, F.col("article_id") == F.col("doc_id"), "left")
    return joined.select(
        *[c for c in joined.columns if c not in ("doc_id", "quality", "toxic")],
        (F.col("quality") / F.lit(2.0)).alias("relevance_score"),
        (F.col("toxic") / F.lit(2.0)).alias("semantic_score"),
        F.when(F.col("quality") == 1, F.col("article_id")).alias("linked_fire_id"),
        F.when(F.col("quality") == 1, F.length("description") / F.lit(100.0)).alias("match_score"),
    )


ENRICHED_SQL = f"""(
    SELECT a.*, quality / 2.0::DOUBLE AS relevance_score, toxic / 2.0::DOUBLE AS semantic_score,
           CASE WHEN quality = 1 THEN article_id END AS linked_fire_id,
           CASE WHEN quality = 1 THEN length(description) / 100.0::DOUBLE END AS match_score
    FROM {ARTICLES_SQL} AS a LEFT JOIN labels ON article_id = doc_id)"""


# ---- embeddings: vectors of news items and of events --------------------------------------

# Label decides the role: the first labels are events, by type, and the others are articles.
WILDFIRE_LABELS = (0, 1, 2)
LANDSLIDE_LABELS = (3, 4)


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = table(spark, sf_dir, "embeddings")
    kind = F.when(F.col("label").isin(*WILDFIRE_LABELS), "wildfire").when(
        F.col("label").isin(*LANDSLIDE_LABELS), "landslide"
    )
    typed = both.withColumn("disaster_type", kind)
    return (
        typed.where("disaster_type IS NULL").select(F.col("vec_id").alias("article_id"), F.col("embedding").alias("vector")),
        typed.where("disaster_type IS NOT NULL").select(
            F.col("vec_id").alias("event_id"), "disaster_type", F.col("embedding").alias("vector")
        ),
    )


VECTORS_SQL = """
    typed AS (
        SELECT vec_id, embedding::DOUBLE[] AS vector,
               CASE WHEN label IN (0, 1, 2) THEN 'wildfire' WHEN label IN (3, 4) THEN 'landslide' END AS disaster_type
        FROM embeddings)"""


# ---- SQL building blocks ------------------------------------------------------------------


def any_sql(text: str, terms: list[str], case_sensitive: bool = False) -> str:
    """``match_any`` in SQL."""
    if not case_sensitive:
        text, terms = f"lower({text})", [t.lower() for t in terms]
    return "coalesce(" + " OR ".join(f"contains({text}, '{t}')" for t in terms) + ", false)"


def type_sql(text: str) -> str:
    return "CASE " + " ".join(f"WHEN {any_sql(text, terms)} THEN '{kind}'" for kind, terms in TYPES.items()) + " END"


def region_sql(lat: str, lon: str) -> str:
    branches = [
        f"WHEN {lat} >= {s} AND {lat} < {n} AND {lon} >= {w} AND {lon} < {e} THEN '{name}'"
        for name, s, n, w, e in REGIONS
    ]
    return "CASE " + " ".join(branches) + " END"
