"""Queries that run a stream over the given tables until it has seen everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from emberlink import lexicons as lx
from emberlink.functions.ids import article_key
from emberlink.plans import standins as st
from emberlink.plans.registry import query
from emberlink.session import scratch_dir
from emberlink.sinks.tables import append_absent, append_table
from emberlink.sinks.topics import publish
from emberlink.streaming import unified as un



def _messages(spark: SparkSession, sf_dir: str) -> str:
    """The articles as topic messages, one language of them broken off; the folder they land in."""
    kind = F.when(F.col("language") == "de", F.lit("landslide")).when(F.col("language") == "en", F.lit("wildfire"))
    body = F.struct(
        "title", "description", "url", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("publishedAt"),
        "source", F.lit("gnews").alias("source_type"), "language", kind.alias("disaster_type"),
    )
    broken = F.concat(F.lit('{"title": "'), F.col("title"))
    messages = st.articles(spark, sf_dir).select(
        F.lit(lx.TOPICS["gnews"]).alias("topic"),
        F.when(F.col("language") == "es", broken).otherwise(F.to_json(body)).alias("value"),
        F.col("published_at").cast("timestamp").alias("timestamp"),
    )
    path = scratch_dir(spark, "messages")
    messages.write.json(path)
    return path


@query(
    "stream_unified",
    f"""
    SELECT 'stored' AS state, 'gnews_articles' AS topic, url, md5(description) AS body, strftime(published_at, '%Y-%m-%d') AS published,
           CASE language WHEN 'de' THEN 'landslide' WHEN 'en' THEN 'wildfire' END AS type, '{st.AS_OF} 00:00:00' AS ingested
    FROM {st.ARTICLES_SQL} AS a WHERE language <> 'es'
    UNION ALL
    SELECT 'quarantined', 'gnews_articles', NULL, md5('{{"title": "' || title), strftime(published_at, '%Y-%m-%d'), NULL,
           '{st.AS_OF} 00:00:00'
    FROM {st.ARTICLES_SQL} AS b WHERE language = 'es'
    """,
)
def stream_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark)
    un.run_unified(un.read_topic_files(spark, _messages(spark, sf_dir)), config)
    stamp = F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested")
    stored = spark.read.parquet(config.table).select(
        F.lit("stored").alias("state"), "topic", "url", F.md5("description").alias("body"),
        F.date_format("published_at", "yyyy-MM-dd").alias("published"), F.col("linked_disaster_type").alias("type"), stamp,
    )
    aside = spark.read.parquet(config.quarantine).select(
        F.lit("quarantined").alias("state"), "topic", F.lit(None).cast("string").alias("url"), F.md5("value").alias("body"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("published"), F.lit(None).cast("string").alias("type"), stamp,
    )
    return stored.unionByName(aside)


_FIRST_COPIES = f"""
    SELECT url, language, title, md5(description) AS body, strftime(published_at, '%Y-%m-%d') AS published
    FROM {st.ARTICLES_SQL} AS a WHERE language <> 'es'
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY published_at, title, description) = 1
"""


def _columns(articles: DataFrame) -> DataFrame:
    day = F.date_format("published_at", "yyyy-MM-dd").alias("published")
    return articles.select("url", "language", "title", F.md5("description").alias("body"), day)


def _config(spark: SparkSession) -> un.StreamConfig:
    return un.StreamConfig(
        scratch_dir(spark, "checkpoint"), scratch_dir(spark, "articles"), scratch_dir(spark, "quarantine"), as_of=st.AS_OF
    )


@query("stream_dedup", _FIRST_COPIES)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each article once, the first to arrive, over thirty days of messages."""
    config = _config(spark)
    un.run_dedup(un.read_topic_files(spark, _messages(spark, sf_dir)), config)
    return _columns(spark.read.parquet(config.table))


@query("stream_then_batch", _FIRST_COPIES.replace("WHERE language <> 'es'", "WHERE true"))
def stream_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream and then a batch write one table; what the stream lost to quarantine the batch adds."""
    config = _config(spark)
    un.run_dedup(un.read_topic_files(spark, _messages(spark, sf_dir)), config)
    articles = st.articles(spark, sf_dir).withColumn("article_id", article_key())
    wanted = articles.select("article_id", "url", "language", "title", "description", F.col("published_at").cast("timestamp").alias("published_at"))
    append_absent(wanted, config.table, "article_id", ["published_at", "title", "description"], as_of=st.AS_OF)
    return _columns(spark.read.option("mergeSchema", "true").parquet(config.table))


@query(
    "stream_decode",
    """
    SELECT event_id, event_type <> 'click' AS valid, CASE WHEN event_type <> 'click' THEN (props->>'k')::BIGINT END AS k
    FROM events
    """,
)
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of events, those of one type broken, in the batch form of the stream's decoder."""
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("_corrupt", T.StringType())])
    value = F.when(F.col("event_type") == "click", F.concat(F.lit("x"), F.col("props"))).otherwise(F.col("props"))
    events = st.table(spark, sf_dir, "events").withColumn("value", value)
    return un.decode(events, schema, keep=["event_id"]).select(
        "event_id", "valid", F.when(F.col("valid"), F.col("body.k")).alias("k")
    )


@query(
    "stream_link",
    f"""
    WITH pairs AS (
        SELECT article_id, fire_id, abs(date_diff('day', f.acq_date, a.published_at::DATE)) AS apart,
               2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(latitude - query_lat) / 2), 2)
                   + cos(radians(query_lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - query_lon) / 2), 2)))) AS km
        FROM {st.PLACED_ARTICLES_SQL} AS a JOIN {st.WILDFIRES_SQL} AS f
            ON abs(date_diff('day', f.acq_date, a.published_at::DATE)) <= 2 AND abs(query_lat - latitude) <= 0.5),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY floor((km + 10 * apart) * 1e9 + 0.5), fire_id) AS rn
        FROM pairs WHERE km <= 50)
    SELECT a.article_id, fire_id AS linked_fire_id, round(km + 10 * apart, 2) AS match_score
    FROM {st.PLACED_ARTICLES_SQL} AS a LEFT JOIN ranked AS r ON r.article_id = a.article_id AND rn = 1
    """,
)
def stream_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed articles against the table of fires; articles without a match stay."""
    landing, out = scratch_dir(spark, "arrivals"), scratch_dir(spark, "linked")
    articles = st.placed_articles(spark, sf_dir)
    articles.write.parquet(landing)
    stream = spark.readStream.schema(articles.schema).parquet(landing)
    un.run_links(
        stream, st.wildfires(spark, sf_dir), out, scratch_dir(spark, "checkpoint"), min_semantic=None, distance="sphere"
    )
    return spark.read.parquet(out).select("article_id", "linked_fire_id", "match_score")


@query(
    "sink_json_value",
    """
    SELECT topic, json_object('event_id', event_id, 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), 'user_id', user_id,
        'event_type', event_type, 'value', value, 'props', props)::VARCHAR AS value
    FROM events, (VALUES ('newsapi_articles')) AS t(topic)
    """,
)
def sink_json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published as JSON; files stand in for the broker."""
    topic = scratch_dir(spark, "topic")
    publish(st.table(spark, sf_dir, "events"), lx.TOPICS["newsapi"], {"path": topic}, fmt="parquet")
    return spark.read.parquet(topic).select("topic", "value")


@query(
    "sink_append",
    f"SELECT fire_id, 2 AS copies, '{st.AS_OF} 00:00:00' AS ingested_at FROM {st.WILDFIRES_SQL} AS w",
)
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk appends look for no duplicates; the stamp is text, as the lake table has it."""
    table = scratch_dir(spark, "lake")
    for _ in range(2):
        append_table(st.wildfires(spark, sf_dir), table, as_of=st.AS_OF, as_text=True)
    counted = spark.read.parquet(table).groupBy("fire_id", "ingested_at").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return counted.select("fire_id", "copies", "ingested_at")


@query(
    "sink_absent",
    "SELECT user_id, arg_min(event_id, (event_id % 4, event_id)) AS event_id FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
)
def sink_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches into one table, first writer wins; a batch opens the folders that may hold its keys."""
    path = scratch_dir(spark, "absent")
    events = st.table(spark, sf_dir, "events").where("user_id is not null").select("user_id", "event_id")
    for turn in range(4):
        append_absent(events.where(F.col("event_id") % 4 == turn), path, "user_id", "event_id", as_of=st.AS_OF)
    return spark.read.parquet(path).select("user_id", "event_id")
