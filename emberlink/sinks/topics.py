"""Publishing records to topics as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def json_value(df: DataFrame, topic: str | None = None) -> DataFrame:
    """One UTF-8 JSON ``value`` per row, fields that are null left out; and the topic, if given."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if topic is None else df.select(F.lit(topic).alias("topic"), value)


def publish(df: DataFrame, topic: str, options: dict[str, str], fmt: str = "kafka", checkpoint: str | None = None) -> StreamingQuery | None:
    """Write every row to ``topic``; a streaming frame returns its running query.

    ``fmt`` may name another sink that takes the same two columns, such as JSON files.
    """
    messages = json_value(df, topic)
    if df.isStreaming:
        writer = messages.writeStream.format(fmt).options(**options).outputMode("append")
        if checkpoint:
            writer = writer.option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
    messages.write.format(fmt).mode("append").options(**options).save()
    return None
