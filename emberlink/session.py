"""Session settings, scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"

#: What results and memory depend on, whoever built the session.
_NEEDED = {
    # Every date and time in the data model is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Python workers take rows by weight, not by number: texts may be long.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304b",
}

_SETTINGS = {
    **_NEEDED,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture costs several JVM round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "emberlink", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's defaults; ``settings`` (dots as ``__``) win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin a session that someone else built to UTC, and its Arrow batches to a few MB."""
    for key, value in _NEEDED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


use_utc = prepare


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see.

    A cluster names it in ``spark.checkpoint.dir``. Only local mode, where driver and
    executors share one disk, may fall back to a temporary folder.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder that all executors can reach")
    fallback = tempfile.mkdtemp(prefix="emberlink-")
    spark.conf.set(SHARED_DIR_KEY, fallback)
    return fallback


_scopes: list[list[str]] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what steps inside have written to the shared folder, once their results are stored."""
    _scopes.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in _scopes.pop():
            place = hadoop.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Shuffle files of a query go when it ends, not when the driver's collector finds that nothing refers to them.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, label: str = "cut", path: str | None = None, free: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder (to ``path`` there, if given) and read it back.

    The copy outlives lost executors, and later jobs start from it instead of
    recomputing what led to it. With ``free``, the shuffle files of the write go as soon as it has ended.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, label)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    if free:
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        elif free:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
