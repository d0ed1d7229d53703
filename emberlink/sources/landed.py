"""Readers for landed news payloads: one shape per feed in, canonical article columns out.

A landed file is either one API response (``lines=False``) or a compacted file with one response
per line (``lines=True``, which Spark can split). Broken payloads become a row with only
``_corrupt`` set; ``malformed`` returns them, the readers leave them out.

Tags that a search cell gives its articles (language, country, query, disaster_type) are
partition folders of the landing path, ``.../language=de/country=CH/...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from emberlink import schemas
from emberlink.functions.text import blank_to_null
from emberlink.functions.times import as_timestamp, parse_published

TAGS = {"language": "language", "country": "country", "query": "query", "disaster_type": "linked_disaster_type"}


def read_json(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False) -> DataFrame:
    """One parsed payload per landed file or line, plus any tag columns."""
    text = spark.read.text(path, wholetext=not lines)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    kept = [c for c in text.columns if c != "value"]
    parsed = F.from_json("value", schema, options)
    return text.select(*kept, parsed.alias("__body")).select(*kept, "__body.*")


def malformed(raw: DataFrame) -> DataFrame:
    """The payloads that could not be parsed."""
    return raw.where(F.col("_corrupt").isNotNull())


def _tags(raw: DataFrame) -> list[Column]:
    return [F.col(c).cast("string").alias(name) for c, name in TAGS.items() if c in raw.columns]


def _items(raw: DataFrame, array: str) -> DataFrame:
    return _exploded(raw, array, "a", [c for c in TAGS if c in raw.columns])


def _exploded(raw: DataFrame, array: str, name: str, kept: list[str]) -> DataFrame:
    """One row per element. A plain ``explode`` would add a filter on the array's size below it,
    and with it a second parse of every payload."""
    return raw.select(F.explode_outer(array).alias(name), *kept).where(F.col(name).isNotNull())


def _published(raw: Column) -> list[Column]:
    return [raw.alias("published_raw"), parse_published(raw).alias("published_at")]


def newsapi_articles(raw: DataFrame) -> DataFrame:
    items = _items(raw, "articles")
    return items.select(
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.url").alias("url"),
        *_published(F.col("a.publishedAt")),
        F.coalesce(F.col("a.source.name"), F.lit("")).alias("source"),
        F.lit("newsapi").alias("source_type"),
        *_tags(items),
    )


def read_newsapi(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return newsapi_articles(read_json(spark, path, schemas.NEWSAPI_RESPONSE, lines))


def gnews_articles(raw: DataFrame, shape: str = "batch") -> DataFrame:
    """``batch`` keeps the content and a fixed source; ``stream`` the description and its outlet."""
    items = _items(raw, "articles")
    if shape == "batch":
        own = [F.col("a.content").alias("content"), F.lit("GNews").alias("source")]
    elif shape == "stream":
        own = [
            F.coalesce(F.col("a.description"), F.lit("")).alias("description"),
            F.coalesce(F.col("a.source.name"), F.lit("")).alias("source"),
        ]
    else:
        raise ValueError(f"unknown shape: {shape}")
    return items.select(
        F.col("a.title").alias("title"),
        F.col("a.url").alias("url"),
        *_published(F.col("a.publishedAt")),
        *own,
        F.lit("gnews").alias("source_type"),
        *_tags(items),
    )


def read_gnews(spark: SparkSession, path: str, lines: bool = False, shape: str = "batch") -> DataFrame:
    return gnews_articles(read_json(spark, path, schemas.GNEWS_RESPONSE, lines), shape)


def mediastack_articles(raw: DataFrame) -> DataFrame:
    """Articles without title or url are left out; the country tag is upper-cased."""
    items = _items(raw, "data")
    articles = items.select(
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.url").alias("url"),
        *_published(F.col("a.published_at")),
        F.col("a.source").alias("source"),
        F.lit("mediastack").alias("source_type"),
        *_tags(items),
    ).where(blank_to_null("title").isNotNull() & blank_to_null("url").isNotNull())
    if "country" in articles.columns:
        articles = articles.withColumn("country", F.upper("country"))
    return articles


def read_mediastack(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return mediastack_articles(read_json(spark, path, schemas.MEDIASTACK_RESPONSE, lines))


def reddit_articles(raw: DataFrame) -> DataFrame:
    posts = raw.where(F.col("_corrupt").isNull()) if "_corrupt" in raw.columns else raw
    return posts.select(
        "title",
        F.coalesce("selftext", F.lit("")).alias("description"),
        "url",
        F.col("created_utc").cast("decimal(20,6)").cast("string").alias("published_raw"),
        F.timestamp_seconds("created_utc").alias("published_at"),
        F.concat(F.lit("r/"), F.col("subreddit")).alias("source"),
        F.lit("reddit").alias("source_type"),
        *_tags(posts),
    )


def read_reddit(spark: SparkSession, path: str) -> DataFrame:
    """Landed forum posts, one JSON object per line."""
    return reddit_articles(read_json(spark, path, schemas.REDDIT_POST, lines=True))


# ---- feeds ------------------------------------------------------------------------------

# The outlet name each feed stamps on its articles.
FEED_SOURCE = {"google_rss": "Google News RSS", "reliefweb_rss": "ReliefWeb", "gdacs": "GDACS RSS"}


def read_feeds(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Parsed RSS documents: ``channel`` and, for a broken feed, ``_corrupt``."""
    text = spark.read.text(path, wholetext=not lines)
    return parse_feeds(text, "value")


def parse_feeds(df: DataFrame, column: str) -> DataFrame:
    parsed = F.from_xml(
        F.col(column),
        schemas.RSS_DOCUMENT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "rowTag": "rss"},
    )
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, parsed.alias("__rss")).select(*kept, "__rss.channel", "__rss._corrupt")


def feed_items(feeds: DataFrame) -> DataFrame:
    """One row per item; a broken feed has none."""
    tags = [c for c in TAGS if c in feeds.columns]
    return _exploded(feeds, "channel.item", "i", tags).select("i.*", *tags)


def rss_articles(feeds: DataFrame, source_type: str, as_of=None) -> DataFrame:
    """``as_of`` stands in for a missing publication date."""
    items = feed_items(feeds)
    published = parse_published(F.col("pubDate"))
    if as_of is not None:
        published = F.when(F.col("pubDate").isNull(), as_timestamp(as_of)).otherwise(published)
    return items.select(
        "title",
        F.coalesce(F.trim("description"), F.lit("")).alias("description"),
        F.col("link").alias("url"),
        F.col("pubDate").alias("published_raw"),
        published.alias("published_at"),
        F.lit(FEED_SOURCE[source_type]).alias("source"),
        F.lit(source_type).alias("source_type"),
        *_tags(items),
    )


def read_rss(
    spark: SparkSession, path: str, source_type: str = "google_rss", lines: bool = False, as_of=None
) -> DataFrame:
    return rss_articles(read_feeds(spark, path, lines), source_type, as_of)


def gdacs_events(feeds: DataFrame, as_of) -> DataFrame:
    """Landslide alerts. Every child is optional: guid falls back to link, date to ``as_of``."""
    items = feed_items(feeds)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return items.where(F.lower(text("title")).contains("landslide")).select(
        F.lit("landslide").alias("type"),
        text("title").alias("title"),
        text("description").alias("description"),
        text("link").alias("link"),
        F.coalesce(F.trim("guid"), text("link")).alias("guid"),
        F.when(F.col("pubDate").isNull(), as_timestamp(as_of))
        .otherwise(parse_published(F.col("pubDate")))
        .alias("published_at"),
        F.lit(FEED_SOURCE["gdacs"]).alias("source"),
        as_timestamp(as_of).alias("ingested_at"),
    )


def read_gdacs(spark: SparkSession, path: str, as_of, lines: bool = False) -> DataFrame:
    return gdacs_events(read_feeds(spark, path, lines), as_of)
