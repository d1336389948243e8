"""Which timetables changed since the last look."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_timetables(current: DataFrame, cached: DataFrame) -> DataFrame:
    """Agencies whose current date is known and differs from, or is missing in, the cache."""
    old = cached.select("agency", F.col("last_modified").alias("cached_modified"))
    return (
        current.where(F.col("last_modified").isNotNull())
        .join(old, "agency", "left")
        .where(~F.col("last_modified").eqNullSafe(F.col("cached_modified")))
        .select("agency", "last_modified", "cached_modified")
    )


def merged_manifest(current: DataFrame, cached: DataFrame) -> DataFrame:
    """The cache after the refresh: new dates win, unknown ones leave the old."""
    old = cached.select("agency", F.col("last_modified").alias("cached_modified"))
    latest = F.coalesce("last_modified", "cached_modified")
    return (
        current.join(old, "agency", "full_outer")
        .select("agency", latest.alias("last_modified"))
        .where(F.col("last_modified").isNotNull())
    )
