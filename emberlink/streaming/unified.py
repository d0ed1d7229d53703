"""One streaming query from all topics to one article table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from emberlink import lexicons as lx, schemas
from emberlink.functions.ids import article_key
from emberlink.functions.times import parse_published
from emberlink.operators.nearest import link_space_time
from emberlink.operators.overlay import overlay
from emberlink.session import scratch_scope
from emberlink.sinks.tables import Sink, make_sink

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def read_topics(
    spark: SparkSession, topics: Iterable[str] = tuple(lx.TOPICS.values()), options: dict[str, str] | None = None
) -> DataFrame:
    """All topics as one stream ``(topic, value, timestamp)``, from the earliest offset on.

    The offsets reached live in the checkpoint of the query that reads the stream.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
    )
    return reader.load().select("topic", F.col("value").cast("string").alias("value"), "timestamp")


def read_topic_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same stream from landed files, one envelope per JSON line."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def decode(df: DataFrame, schema: T.StructType = schemas.TOPIC_MESSAGE, keep: Iterable[str] = ("topic", "timestamp")) -> DataFrame:
    """Parse ``value``; ``valid`` tells whether it was JSON of the expected shape.

    A payload that does not parse is a row like any other, so it cannot stop the query.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    body = F.from_json("value", schema, options).alias("body")
    parsed = df.select(*keep, "value", body)
    return parsed.withColumn(
        "valid", F.col("value").isNotNull() & F.col("body").isNotNull() & F.col("body._corrupt").isNull()
    )


def messages_to_articles(decoded: DataFrame) -> DataFrame:
    """Decoded messages as article columns; topic and arrival time stay."""
    m = lambda name: F.col(f"body.{name}")
    articles = decoded.select(
        "topic",
        F.col("timestamp").alias("received_at"),
        *[m(c).alias(c) for c in ("title", "description", "url", "source", "source_type", "language", "country", "query")],
        m("publishedAt").alias("published_raw"),
        parse_published(m("publishedAt")).alias("published_at"),
        m("disaster_type").alias("linked_disaster_type"),
    )
    return articles.select(article_key().alias("article_id"), *articles.columns)


def split_batch(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good articles, and what has to be looked at: ``(topic, timestamp, value)``."""
    return split_decoded(decode(batch))


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        messages_to_articles(decoded.where("valid")),
        decoded.where("NOT valid").select("topic", "timestamp", "value"),
    )


@dataclass
class StreamConfig:
    checkpoint: str
    table: str
    quarantine: str
    backend: str = "parquet"
    as_of: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def run_unified(stream: DataFrame, config: StreamConfig, wait: bool = True):
    """Consume what is there, store articles and quarantine the rest; then stop.

    Restarted from its checkpoint it goes on where it ended, so any scheduler can call it.
    """
    good_sink = make_sink(config.backend, config.table, config.as_of)
    bad_sink = make_sink("parquet", config.quarantine, config.as_of)

    return _run(stream, _both(good_sink, bad_sink), config.checkpoint, config.options, wait)


def _both(good_sink: Sink, bad_sink: Sink) -> Sink:
    """Decode a batch once, then store its articles and what has to be looked at."""

    def store(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch).persist()
        try:
            good, bad = split_decoded(decoded)
            good_sink(good, batch_id)
            bad_sink(bad, batch_id)
        finally:
            decoded.unpersist()

    return store


def _run(stream: DataFrame, store: Sink, checkpoint: str, options: dict[str, str], wait: bool):
    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def run_dedup(stream: DataFrame, config: StreamConfig, wait: bool = True):
    """Consume what is there and store each article once; quarantine the rest.

    Every batch is held against the table itself, so an article is stored however late it
    comes, and a copy is found however long ago the first came: no watermark, no state to outgrow.
    A batch reads one column of the table. Of copies within a batch the first to arrive stays,
    chosen in each task before the shuffle, so a hot article sends one row a task.
    """
    order = ("received_at", "published_raw", "title", "description")
    good_sink = make_sink(config.backend, config.table, config.as_of, absent=("article_id", order))
    bad_sink = make_sink("parquet", config.quarantine, config.as_of)
    return _run(stream, _both(good_sink, bad_sink), config.checkpoint, config.options, wait)


def run_links(stream: DataFrame, fires: DataFrame, path: str, checkpoint: str, wait: bool = True, **link_options):
    """Link streamed articles to a table of fires, batch by batch.

    All fires an article could match are in the table, so its best match needs no state. A batch
    reads only the fires of its own dates and the days around them.
    """
    sink = make_sink("parquet", path)
    days = link_options.get("days", lx.LINK_DAYS)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch, spark = batch.persist(), batch.sparkSession
        try:
            first, last = batch.agg(F.min("published_at").cast("date"), F.max("published_at").cast("date")).first()
            near = F.lit(False) if first is None else F.col("acq_date").cast("date").between(F.date_sub(F.lit(first), days), F.date_add(F.lit(last), days))
            with scratch_scope(spark):
                links = link_space_time(batch, fires.where(near), **link_options)
                sink(overlay(batch, links, "article_id", ["linked_fire_id", "match_score"]), batch_id)
        finally:
            batch.unpersist()

    return _run(stream, store, checkpoint, {}, wait)
