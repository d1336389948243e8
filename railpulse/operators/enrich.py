"""Attach direction and schedule metrics to station rows.

All joins are left joins to a side with one row per key, so they never change the row
count. No side is broadcast by hint: adaptive execution decides by measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.functions.timecols import percent
from railpulse.operators.timetable import join_on


def headsign_direction(lookup: Mapping[str, int], headsign: Column) -> Column:
    """Direction from a small fixed table of headsigns, null where it has none."""
    table = F.create_map(*[F.lit(x) for x in chain(*lookup.items())])
    return F.try_element_at(table, headsign).cast("int")


def with_headsign_direction(
    stops: DataFrame, lookup: Mapping[str, int], column: str = "destCode"
) -> DataFrame:
    """``direction_id`` from headsigns, for feeds without direction ids."""
    return stops.withColumn("direction_id", headsign_direction(lookup, F.col(column)))


def with_direction(
    stops: DataFrame,
    by_train_number: DataFrame,
    by_last_stop: DataFrame,
    feed: Sequence[str] = (),
    headsigns: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """``direction_id`` and ``lookup_method``: by train number, else by destination.

    ``headsigns`` (provider -> table) replaces both lookups for the providers in it.
    """
    primary = by_train_number.select(
        *feed, F.col("trip_short_name").alias("trainNumRaw"),
        F.col("direction_id").alias("_primary"))
    secondary = by_last_stop.select(
        *feed, F.col("headsign_stop_id").alias("destCode"),
        F.col("direction_id").alias("_secondary"))
    both = join_on(
        join_on(stops, primary, [*feed, "trainNumRaw"]), secondary, [*feed, "destCode"])
    direction = F.coalesce("_primary", "_secondary")
    method = F.when(F.col("_primary").isNotNull(), F.lit("primary")).when(
        F.col("_secondary").isNotNull(), F.lit("secondary"))
    for provider, lookup in (headsigns or {}).items():
        own = F.col("provider") == provider
        direction = F.when(own, headsign_direction(lookup, F.col("destCode"))).otherwise(direction)
        method = F.when(own, F.lit(None).cast("string")).otherwise(method)
    return both.withColumns({"direction_id": direction, "lookup_method": method}).drop(
        "_primary", "_secondary")


def with_scheduled_metrics(
    stops: DataFrame, means: DataFrame, feed: Sequence[str] = ()
) -> DataFrame:
    """Mean headway and travel time of the stop and direction, halves to even, as integers."""
    per_stop = means.select(
        *feed, F.col("stop_id").alias("code"), "direction_id",
        *[F.bround(F.col(c), 0).cast("bigint").alias(c)
          for c in ("scheduled_headway", "scheduled_tt")])
    return join_on(stops, per_stop, [*feed, "code", "direction_id"])


def direction_match_columns() -> list[Column]:
    """Hits of either lookup, misses and match rate, as aggregates."""
    hits = F.count_if(F.col("lookup_method").isNotNull())
    return [
        F.count_if(F.col("lookup_method") == "primary").alias("primary_hits"),
        F.count_if(F.col("lookup_method") == "secondary").alias("secondary_hits"),
        F.count_if(F.col("direction_id").isNull()).alias("misses"),
        percent(hits, F.count(F.lit(1))).alias("match_rate_pct"),
    ]


def metric_match_columns() -> list[Column]:
    """Rows with and without schedule metrics, and match rate, as aggregates."""
    found = F.count_if(F.col("scheduled_headway").isNotNull())
    return [
        found.alias("metrics_found"),
        F.count_if(F.col("scheduled_headway").isNull()).alias("metrics_missing"),
        percent(found, F.count(F.lit(1))).alias("match_rate_pct"),
    ]


def direction_match_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(*direction_match_columns())


def metric_match_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(*metric_match_columns())
