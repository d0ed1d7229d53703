"""One table of hazards from fires and landslides, and counts over it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from emberlink import lexicons as lx


def hazards_union(fires: DataFrame, slides: DataFrame) -> DataFrame:
    """Fires and landslides as ``(hazard_id, disaster_type, latitude, longitude, event_date)``."""
    def shaped(df: DataFrame, key: str, kind: str, date: str) -> DataFrame:
        return df.select(
            F.col(key).cast("string").alias("hazard_id"),
            F.lit(kind).alias("disaster_type"),
            "latitude",
            "longitude",
            F.col(date).cast("date").alias("event_date"),
        )

    return shaped(fires, "fire_id", lx.WILDFIRE, "acq_date").unionByName(
        shaped(slides, "event_id", lx.LANDSLIDE, "date")
    )


def hazard_counts(
    hazards: DataFrame, as_of: str | dt.date, days: int = lx.HAZARD_DAYS, by: tuple[str, ...] = ("disaster_type",)
) -> DataFrame:
    """Recent hazards per type, or per any other columns."""
    oldest = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return hazards.where(F.col("event_date") >= oldest).groupBy(*by).agg(F.count(F.lit(1)).alias("hazards"))
