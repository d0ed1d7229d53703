"""Appending to tables, and routing to a backend by name.

Every write to a file table owns one folder, ``writer=W/batch_id=N``, and overwrites it. A stream
writes as its query id, which lives in its checkpoint, so a micro-batch that runs again replaces
itself, and a second query or a fresh checkpoint never touches what others wrote. A batch write is
a writer of its own. All writers share this layout, so a table reads whole whoever wrote it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlink.functions.times import as_timestamp
from emberlink.operators.dedup import insert_absent
from emberlink.sinks.key_filters import drop_filter, folders_to_open, write_filter

Sink = Callable[[DataFrame, int], None]

# Backend names of the configuration, and the table format behind each.
BACKENDS = {"mongo": "parquet", "delta": "delta", "parquet": "parquet", "orc": "orc", "json": "json"}

_QUERY_ID = "sql.streaming.queryId"  # set by Spark on the thread that runs a micro-batch


def stamp(df: DataFrame, as_of=None, as_text: bool = False) -> DataFrame:
    """Set the time of ingestion, as a timestamp or as text."""
    now = F.current_timestamp() if as_of is None else as_timestamp(as_of)
    return df.withColumn("ingested_at", now.cast("string") if as_text else now)


def _folder(path: str, writer: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/writer={writer}/batch_id={batch_id}"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, asked of the file system that holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def stored_keys(spark: SparkSession, path: str, fmt: str, like: DataFrame, without: tuple[str, int] | None = None) -> DataFrame:
    """The rows a table holds, in the columns of ``like``, from the folders that may hold rows of ``like``; none if it is not there yet.

    ``without`` leaves out one folder (writer, batch id): a batch that runs again must not meet itself.
    """
    if not table_exists(spark, path):
        return like.limit(0)
    if fmt == "delta":
        return spark.read.format(fmt).load(path)
    folders = folders_to_open(spark, path, like, like.columns)
    if without and (own := _folder(path, *without)) in folders:
        folders.remove(own)
    # The schema is given, so folders without a file read as empty.
    return spark.read.schema(like.schema).format(fmt).load(folders).select(*like.columns) if folders else like.limit(0)


def _write_folder(stamped: DataFrame, path: str, fmt: str, writer: str, batch_id: int, key: list[str], partition_by: list[str] | None = None) -> None:
    """Write one folder and, where the table has a ``key``, its filter."""
    spark, folder = stamped.sparkSession, _folder(path, writer, batch_id)
    if key:
        drop_filter(spark, path, writer, batch_id)
    to = stamped.write.mode("overwrite")
    if partition_by:
        to = to.partitionBy(*partition_by)
    to.format(fmt).save(folder)
    if key:
        write_filter(spark.read.schema(stamped.schema).format(fmt).load(folder), path, writer, batch_id, key)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key or [])


def append_table(
    df: DataFrame, path: str, fmt: str = "parquet", as_of=None, as_text: bool = False, partition_by: list[str] | None = None, key=None
) -> None:
    """Append as it is, without looking for duplicates. With a ``key``, later look-ups open the folder only if it may hold theirs."""
    stamped = stamp(df, as_of, as_text)
    if fmt == "delta":
        writer = stamped.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).format(fmt).save(path)
    else:
        _write_folder(stamped, path, fmt, f"batch-{uuid.uuid4().hex}", 0, _keys(key), partition_by)


def append_absent(new: DataFrame, path: str, key, order, fmt: str = "parquet", as_of=None) -> None:
    """Append the rows whose key the table at ``path`` lacks; first per key. One writer at a time."""
    target = stored_keys(new.sparkSession, path, fmt, new.select(*_keys(key)))
    append_table(insert_absent(new, target, key, order), path, fmt, as_of, key=key)


def make_sink(
    backend: str, path: str, as_of=None, as_text: bool | None = None, writer: str | None = None, absent: tuple | None = None
) -> Sink:
    """A ``foreachBatch`` writer. An unknown backend fails here, before anything is read.

    ``writer`` is the streaming query's id unless given. ``absent=(key, order)`` stores only rows
    whose key the table lacks, first per key, however late they come. Delta keeps a batch from
    appearing twice with its transaction ids.
    """
    if backend not in BACKENDS:
        raise ValueError(f"unknown storage backend {backend!r}; known: {', '.join(BACKENDS)}")
    fmt = BACKENDS[backend]
    text_stamp = backend == "delta" if as_text is None else as_text

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = writer or spark.sparkContext.getLocalProperty(_QUERY_ID)
        if not name:
            raise ValueError("outside a streaming query a sink needs the name of its writer")
        if absent:
            key, order = absent
            batch = insert_absent(batch, stored_keys(spark, path, fmt, batch.select(*_keys(key)), (name, batch_id)), key, order)
        stamped = stamp(batch, as_of, text_stamp)
        if fmt == "delta":
            (
                stamped.write.format("delta").mode("append")
                .option("txnAppId", name).option("txnVersion", batch_id).save(path)
            )
        else:
            _write_folder(stamped, path, fmt, name, batch_id, _keys(absent[0]) if absent else [])

    return write
