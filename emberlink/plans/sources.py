"""Queries that land the given tables as feeds would, and read them back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from emberlink.plans import standins as st
from emberlink.plans.registry import query
from emberlink.session import scratch_dir
from emberlink.sinks.tables import append_table
from emberlink.sources import exports, hazards, landed

# Articles per landed response, as many as a search returns.
PER_RESPONSE = 50


def _iso(column: str = "published_at") -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _day(column: str = "published_at") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _responses(rows: DataFrame, key: str, item: Column, field: str) -> DataFrame:
    """One JSON response per line, each with the items of 50 neighbouring ids."""
    grouped = rows.groupBy(F.floor(F.col(key) / PER_RESPONSE).alias("g")).agg(F.collect_list(item).alias(field))
    return grouped.select(F.to_json(F.struct(field)).alias("value"))


def _land(lines: DataFrame, label: str) -> str:
    path = scratch_dir(lines.sparkSession, label)
    lines.write.text(path)
    return path


_SHOWN_SQL = "strftime(published_at, '%Y-%m-%d') AS published"


@query(
    "src_newsapi",
    f"""SELECT title, md5(description) AS body, url, {_SHOWN_SQL}, coalesce(outlet, '') AS source, 'newsapi' AS source_type
    FROM (SELECT *, CASE WHEN relevance_score IS NOT NULL THEN source END AS outlet FROM {st.ENRICHED_SQL} AS e)""",
)
def src_newsapi(spark: SparkSession, sf_dir: str) -> DataFrame:
    outlet = F.when(F.col("relevance_score").isNotNull(), F.col("source"))
    item = F.struct(F.struct(outlet.alias("name")).alias("source"), "title", "description", "url", _iso().alias("publishedAt"))
    path = _land(_responses(st.enriched(spark, sf_dir), "article_id", item, "articles"), "newsapi")
    return landed.read_newsapi(spark, path, lines=True).select(
        "title", F.md5("description").alias("body"), "url", _day().alias("published"), "source", "source_type"
    )


@query(
    "src_gnews",
    f"""
    SELECT shape, title, md5(body) AS body, url, {_SHOWN_SQL}, CASE shape WHEN 'batch' THEN 'GNews' ELSE source END AS source
    FROM (SELECT *, unnest(['batch', 'stream']) AS shape FROM {st.ARTICLES_SQL} AS a) AS b,
         LATERAL (SELECT CASE shape WHEN 'batch' THEN description ELSE language END AS body) AS c
    """,
)
def src_gnews(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        F.struct(F.col("source").alias("name")).alias("source"), "title",
        F.col("language").alias("description"), F.col("description").alias("content"), "url", _iso().alias("publishedAt"),
    )
    path = _land(_responses(st.articles(spark, sf_dir), "article_id", item, "articles"), "gnews")
    batch = landed.read_gnews(spark, path, lines=True).withColumnRenamed("content", "body")
    stream = landed.read_gnews(spark, path, lines=True, shape="stream").withColumnRenamed("description", "body")
    both = [df.select(F.lit(shape).alias("shape"), "title", F.md5("body").alias("body"), "url", _day().alias("published"), "source")
            for shape, df in (("batch", batch), ("stream", stream))]
    return both[0].unionByName(both[1])


@query(
    "src_mediastack",
    f"""SELECT title, md5(description) AS body, url, {_SHOWN_SQL}, source
    FROM {st.ENRICHED_SQL} AS e WHERE relevance_score IS NOT NULL AND semantic_score = 0""",
)
def src_mediastack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without title or url are left out: here, where the labels say so."""
    item = F.struct(
        F.when(F.col("relevance_score").isNotNull(), F.col("title")).otherwise("").alias("title"),
        "description",
        F.when(F.col("semantic_score") == 0, F.col("url")).alias("url"),
        _iso().alias("published_at"),
        "source",
    )
    path = _land(_responses(st.enriched(spark, sf_dir), "article_id", item, "data"), "mediastack")
    return landed.read_mediastack(spark, path, lines=True).select(
        "title", F.md5("description").alias("body"), "url", _day().alias("published"), "source"
    )


@query(
    "src_reddit",
    """
    SELECT 'r/' || role AS source, md5(coalesce(text, '')) AS body, 'https://forum.example/' || conv_id || '/' || turn AS url,
           strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 60 + turn), '%Y-%m-%d %H:%M:%S') AS published
    FROM conversations
    """,
)
def src_reddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = st.table(spark, sf_dir, "conversations").select(
        F.col("role").alias("subreddit"),
        F.concat(F.lit("turn "), F.col("turn")).alias("title"),
        F.col("text").alias("selftext"),
        F.concat_ws("/", F.lit("https://forum.example"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("url"),
        (F.lit(1704067200.0) + F.col("conv_id") * 60 + F.col("turn")).alias("created_utc"),
    )
    path = _land(posts.select(F.to_json(F.struct(*posts.columns))), "reddit")
    return landed.read_reddit(spark, path).select(
        "source", F.md5("description").alias("body"), "url", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published")
    )


def _xml(name: str, value: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def _feeds(pages: DataFrame, item: Column) -> DataFrame:
    """One RSS document per line with the items of 50 neighbouring pages."""
    items = pages.groupBy(F.floor(F.col("page_id") / PER_RESPONSE).alias("g")).agg(F.collect_list(item).alias("items"))
    feed = F.concat(F.lit('<rss version="2.0"><channel><title>feed</title>'), F.array_join("items", ""), F.lit("</channel></rss>"))
    return items.select(F.regexp_replace(feed, "[\r\n]+", " ").alias("value"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_replace("html", "[\r\n]+", " ").alias("html"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("html", '<html lang="([a-z]*)"', 1).alias("lang"),
        (F.lit("2024-01-01 06:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("page_id") % 30).cast("int"))).alias("published_at"),
    )


_PAGES_SQL = """(
    SELECT page_id, url, regexp_replace(html, '[\\r\\n]+', ' ', 'g') AS html,
           regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang,
           TIMESTAMP '2024-01-01 06:00:00' + to_days((page_id % 30)::INTEGER) AS published_at
    FROM pages)"""


@query(
    "src_rss_items",
    f"""SELECT source, trim(title) AS title, md5(trim(html)) AS body, url, {_SHOWN_SQL}
    FROM {_PAGES_SQL} AS p, (VALUES ('Google News RSS'), ('ReliefWeb')) AS s(source)""",
)
def src_rss_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.concat(
        F.lit("<item>"),
        _xml("title", F.col("title")),
        _xml("link", F.col("url")),
        _xml("description", F.col("html")),
        _xml("pubDate", F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")),
        F.lit("</item>"),
    )
    path = _land(_feeds(_pages(spark, sf_dir), item), "rss")
    read = [landed.read_rss(spark, path, kind, lines=True) for kind in ("google_rss", "reliefweb_rss")]
    return read[0].unionByName(read[1]).select(
        "source", F.coalesce("title", F.lit("")).alias("title"), F.md5("description").alias("body"), "url", _day().alias("published")
    )


@query(
    "src_gdacs",
    f"""
    SELECT 'Landslide ' || page_id AS title, url AS link, CASE WHEN lang = 'en' THEN 'g' || page_id ELSE url END AS guid,
           CASE WHEN lang = 'de' THEN '{st.AS_OF}' ELSE strftime(published_at, '%Y-%m-%d') END AS published
    FROM {_PAGES_SQL} AS p WHERE lang IN ('en', 'de')
    """,
)
def src_gdacs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts for two of the languages; one lacks the date, the other has a guid."""
    kind = F.when(F.col("lang").isin("en", "de"), F.lit("Landslide ")).otherwise(F.lit("Flood "))
    item = F.concat(
        F.lit("<item>"),
        _xml("title", F.concat(kind, F.col("page_id").cast("string"))),
        _xml("link", F.col("url")),
        F.when(F.col("lang") == "en", _xml("guid", F.concat(F.lit("g"), F.col("page_id").cast("string")))).otherwise(""),
        F.when(F.col("lang") == "de", F.lit("")).otherwise(
            _xml("pubDate", F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        ),
        F.lit("</item>"),
    )
    path = _land(_feeds(_pages(spark, sf_dir), item), "gdacs")
    return landed.read_gdacs(spark, path, st.AS_OF, lines=True).select("title", "link", "guid", _day().alias("published"))


@query(
    "src_fires",
    f"""
    SELECT round(latitude, 2) AS latitude, round(longitude, 2) AS longitude, strftime(acq_date, '%Y-%m-%d') AS acq_date,
           acq_time, frp, 'NASA_FIRMS' AS source
    FROM {st.WILDFIRES_SQL} AS w
    """,
)
def src_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections through a CSV file, appended to a table and read from there."""
    rows = st.wildfires(spark, sf_dir).select(
        F.lit("DEU").alias("country_id"), "latitude", "longitude", F.lit(300.5).alias("bright_ti4"), F.lit("n").alias("confidence"),
        "acq_date", F.col("acq_time").cast("int").alias("acq_time"), F.lit("N").alias("satellite"), F.lit("VIIRS").alias("instrument"),
        "frp", F.lit("D").alias("daynight"),
    )
    # The feed's own header is wider than the model, and in another order.
    rows = rows.withColumns({"scan": F.lit(0.4), "track": F.lit(0.4), "version": F.lit("2.0NRT"), "bright_ti5": F.lit(290.1)})
    rows = rows.select("latitude", "longitude", "bright_ti4", "scan", "track", "acq_date", "acq_time", "satellite", "instrument",
                       "confidence", "version", "bright_ti5", "frp", "daynight", "country_id")
    path, table = scratch_dir(spark, "firms"), scratch_dir(spark, "wildfires")
    rows.write.option("header", True).csv(path)
    append_table(hazards.read_firms_csv(spark, path, st.AS_OF), table, as_of=st.AS_OF)
    return spark.read.parquet(table).select(
        F.round("latitude", 2).alias("latitude"), F.round("longitude", 2).alias("longitude"),
        F.col("acq_date").cast("string").alias("acq_date"), "acq_time", "frp", "source",
    )


@query(
    "src_rejects",
    f"""
    SELECT 'firms' AS source, 'latitude' AS reason, count(*) AS n FROM {st.WILDFIRES_SQL} AS w WHERE longitude >= 10 HAVING count(*) > 0
    UNION ALL SELECT 'firms', 'broken', count(*) FROM {st.WILDFIRES_SQL} AS w WHERE longitude < 7 HAVING count(*) > 0
    UNION ALL SELECT 'landslides', CASE WHEN latitude < 50 THEN 'broken' ELSE 'longitude' END, count(*)
    FROM {st.LANDSLIDES_SQL} AS l WHERE latitude < 50 OR longitude < 8 GROUP BY ALL
    """,
)
def src_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that cannot be read are set aside with what is wrong with them."""
    w = st.wildfires(spark, sf_dir)
    latitude = F.when(F.col("longitude") >= 10, F.lit("xx")).otherwise(F.col("latitude").cast("string"))
    cells = [latitude, F.col("longitude").cast("string"), F.col("acq_date").cast("string"), F.col("acq_time").cast("string"), F.col("frp").cast("string")]
    line = F.concat_ws(",", *cells, *[F.when(F.col("longitude") < 7, F.lit("one,too,many"))])
    header = spark.createDataFrame([("latitude,longitude,acq_date,acq_time,frp",)], "value string")
    fires = scratch_dir(spark, "firms")
    header.unionByName(w.select(line.alias("value"))).coalesce(1).write.text(fires)
    bad_fires = hazards.split_firms(hazards.read_firms_raw(spark, fires))[1].select(F.lit("firms").alias("source"), "reason")

    l = st.landslides(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in ("event_id", "date", "latitude", "longitude")])
    odd = l.withColumn("longitude", F.when(F.col("longitude").cast("double") < 8, F.lit("unknown")).otherwise(F.col("longitude")))
    text = F.to_json(F.struct(*odd.columns))
    cut = F.when(F.col("latitude").cast("double") < 50, F.concat(F.lit("["), text)).otherwise(text)
    raw = hazards.read_landslides_raw(spark, _land(odd.select(cut), "landslides"), lines=True)
    bad_slides = hazards.landslide_rejects(raw).select(F.lit("landslides").alias("source"), "reason")
    return bad_fires.unionByName(bad_slides).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_landslides",
    f"""
    SELECT event_id::VARCHAR AS event_id, round(latitude, 2) AS latitude, strftime(date, '%Y-%m-%d') AS date
    FROM {st.LANDSLIDES_SQL} AS l WHERE longitude >= 8
    """,
)
def src_landslides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows, where some have no number for a longitude."""
    rows = st.landslides(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("date").cast("string").alias("date"),
        F.col("latitude").cast("string").alias("latitude"),
        F.when(F.col("longitude") >= 8, F.col("longitude").cast("string")).otherwise("unknown").alias("longitude"),
    )
    path = _land(rows.select(F.to_json(F.struct(*rows.columns))), "landslides")
    return hazards.read_landslides(spark, path, st.AS_OF, lines=True).select(
        "event_id", F.round("latitude", 2).alias("latitude"), F.col("date").cast("string").alias("date")
    )


def _as_arrays(rows: DataFrame) -> DataFrame:
    """Lines of files that are one JSON array each."""

    def wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = "["
        for batch in batches:
            values = batch["value"].tolist()
            if values:
                yield pd.DataFrame({"value": [mark + values[0], *["," + v for v in values[1:]]]})
                mark = ","
        yield pd.DataFrame({"value": ["]" if mark == "," else "[]"]})

    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).mapInPandas(wrap, "value string")


@query(
    "src_landslide_arrays",
    f"""
    SELECT event_id::VARCHAR AS event_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, strftime(date, '%Y-%m-%d') AS date,
           'catalog }} ' || event_id AS source_name, 'landslide' AS type
    FROM {st.LANDSLIDES_SQL} AS l
    """,
)
def src_landslide_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog from files that are one array each, read in blocks; all columns that are filled."""
    rows = st.landslides(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("date").cast("string").alias("date"),
        F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"),
        F.concat(F.lit("catalog } "), F.col("event_id").cast("string")).alias("source_name"),
    )
    path = _land(_as_arrays(rows), "landslides")
    return hazards.read_landslides(spark, path, st.AS_OF).select(
        "event_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), F.col("date").cast("string").alias("date"), "source_name", "type"
    )


@query(
    "src_fire_headers",
    f"""
    SELECT CASE WHEN longitude >= 10 THEN 'CHE' ELSE 'DEU' END AS country, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
           strftime(acq_date, '%Y-%m-%d') AS acq_date, acq_time, CASE WHEN longitude >= 10 THEN frp END AS frp
    FROM {st.WILDFIRES_SQL} AS w
    """,
)
def src_fire_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts in one folder: columns in another order, some missing from one."""
    w, path = st.wildfires(spark, sf_dir).withColumn("acq_time", F.col("acq_time").cast("int")), scratch_dir(spark, "firms")
    west = w.where("longitude < 10").select("longitude", "latitude", "acq_time", "acq_date")
    east = w.where("longitude >= 10").select(F.lit("CHE").alias("country_id"), "acq_date", "latitude", "frp", "longitude", "acq_time")
    for rows in (west, east):
        rows.write.mode("append").option("header", True).csv(path)
    return hazards.read_firms_csv(spark, path, st.AS_OF).select(
        "country", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), F.col("acq_date").cast("string").alias("acq_date"), "acq_time", "frp"
    )


@query(
    "src_exports",
    f"""
    SELECT 'articles' AS collection, url AS id, strftime(published_at, '%Y-%m-%d') AS day, count(*) AS n FROM {st.ARTICLES_SQL} AS a GROUP BY ALL
    UNION ALL SELECT 'articles', 'https://gnews.example/' || conv_id || '/' || turn, NULL, 1 FROM conversations
    UNION ALL SELECT 'landslides', event_id::VARCHAR, strftime(date, '%Y-%m-%d'), 1 FROM {st.LANDSLIDES_SQL} AS l
    UNION ALL SELECT 'wildfires', fire_id::VARCHAR, strftime(acq_date, '%Y-%m-%d'), 1 FROM {st.WILDFIRES_SQL} AS w
    """,
)
def src_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four exported collections, one object per line."""
    base = scratch_dir(spark, "exports")
    news = st.articles(spark, sf_dir).select("title", "description", "url", "source", _iso().alias("publishedAt"))
    second = st.table(spark, sf_dir, "conversations").select(
        F.col("text").alias("content"),
        F.concat_ws("/", F.lit("https://gnews.example"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("url"),
    )
    fires = st.wildfires(spark, sf_dir).withColumn("fire_id", F.col("fire_id").cast("string"))
    slides = st.landslides(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("string"))
    for name, rows in (("news", news), ("gnews", second), ("wildfires", fires), ("landslides", slides)):
        rows.write.json(f"{base}/{exports.EXPORT_FILES[name]}")
    tables = exports.load_exports(spark, base, lines=True)
    parts = [
        tables["articles"].select(F.col("url").alias("id"), _day().alias("day"), F.lit("articles").alias("collection")),
        tables["wildfires"].select(F.col("fire_id").alias("id"), _day("acq_date").alias("day"), F.lit("wildfires").alias("collection")),
        tables["landslides"].select(F.col("event_id").alias("id"), _day("date").alias("day"), F.lit("landslides").alias("collection")),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy("collection", "id", "day").agg(F.count(F.lit(1)).alias("n"))
