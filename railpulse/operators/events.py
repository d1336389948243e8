"""Arrival and departure events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.functions import timecols
from railpulse.schemas import EVENT, EVENT_COLUMNS

# What makes two events the same report.
SAME_REPORT = ("provider", "trip_id", "stop_id", "event_type", "event_time")


def arr_dep_events(stops: DataFrame, carry: Sequence[str] = ("provider",)) -> DataFrame:
    """Up to two events per station row, from one scan of the rows.

    ``carry`` are columns kept beside the twelve event fields.
    """
    halves = stops.select(
        *carry,
        F.col("routeName").alias("route_id"),
        F.col("trainNumRaw").alias("trip_id"),
        F.col("direction_id").cast("int").alias("direction_id"),
        F.col("code").alias("stop_id"),
        F.col("scheduled_headway").cast("bigint").alias("scheduled_headway"),
        F.col("scheduled_tt").cast("bigint").alias("scheduled_tt"),
        F.stack(F.lit(2), F.lit("ARR"), F.col("arr"), F.lit("DEP"), F.col("dep")).alias(
            "event_type", "at"),
    ).where(F.col("at").isNotNull())
    events = halves.withColumns({
        "service_date": timecols.service_date(F.col("at")).cast("string"),
        "event_time": timecols.iso_text(F.col("at")),
        "stop_sequence": F.lit(None).cast(EVENT["stop_sequence"].dataType),
        "vehicle_id": F.col("trip_id"),
        "vehicle_label": F.col("trip_id"),
    })
    return events.select(*carry, *EVENT_COLUMNS)


def event_counts(events: DataFrame) -> DataFrame:
    """Arrivals, departures and all events per provider."""
    return events.groupBy("provider").agg(
        F.count_if(F.col("event_type") == "ARR").alias("arrivals"),
        F.count_if(F.col("event_type") == "DEP").alias("departures"),
        F.count(F.lit(1)).alias("events"),
    )


def dedupe_events(events: DataFrame, keys: Sequence[str] = SAME_REPORT) -> DataFrame:
    """One event per key, the earliest landed (``landed_at``, where present); of several, the
    smallest by the event's fields. Copies collapse map-side before the shuffle."""
    others = [c for c in events.columns if c not in keys]
    order = [c for c in ("landed_at", *EVENT_COLUMNS) if c in others]
    order += [c for c in others if c not in order]
    first = events.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(*[c if c in keys else F.col(f"_first.{c}") for c in events.columns])
