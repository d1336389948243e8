"""Headways among trips that run on the same day, by service calendar.

A service runs on the weekdays of its pattern within its dates, plus added and minus removed
days. Days on which the very same services run are one *day type*, named by its first date.
Headways are computed once per day type, not per day: a timetable of a year has tens of day
types, so there is a row per trip, stop and day type of its service, never one per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.operators.timetable import join_on, with_scheduled_headway

#: Weekday columns of a calendar, in the order of Spark's ``weekday``.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ADDED, REMOVED = 1, 2


def active_days(calendar: DataFrame, exceptions: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """``feed, service_id, service_day``, each once.

    ``calendar``: service, a flag (1 or 0) per weekday, ``start_date`` and ``end_date``, both
    included. ``exceptions``: service, ``date`` and ``exception_type``. A day both added and removed
    is removed; repeated rows count once; patterns with a null or reversed date have no days.
    """
    keys = [*feed, "service_id"]
    dated = calendar.where("start_date <= end_date").withColumn(
        "service_day", F.explode(F.sequence("start_date", "end_date")))
    runs = F.element_at(F.array(*WEEKDAYS), F.weekday("service_day") + 1) == 1
    of_kind = {kind: exceptions.where(F.col("exception_type") == kind).select(
        *keys, F.col("date").alias("service_day")) for kind in (ADDED, REMOVED)}
    return (dated.where(runs).select(*keys, "service_day").unionByName(of_kind[ADDED]).dropna()
            .join(of_kind[REMOVED], [*keys, "service_day"], "left_anti").distinct())


def day_types(days: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """``feed, service_day, day_type``: the first date on which the same services run.

    The list of a day is bounded by the number of services, which doesn't grow with trips.
    """
    sets = days.groupBy(*feed, "service_day").agg(
        F.sha2(F.to_json(F.array_sort(F.collect_set("service_id"))), 256).alias("_set"))
    first = sets.groupBy(*feed, "_set").agg(F.min("service_day").alias("day_type"))
    return join_on(sets, first, [*feed, "_set"], hot=False).drop("_set")


def with_headway_by_day_type(stops: DataFrame, days: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """Stops (with ``service_id``) once per day type of their service, with ``scheduled_headway``.

    Stops whose service never runs have no day type and no row. A service may hold any share of
    the trips: its few day types are joined to them, and split where hot.
    """
    keys = [*feed, "service_id"]
    by_day = [*feed, "service_day"]
    types = join_on(days, day_types(days, feed), by_day, hot=False).select(*keys, "day_type").distinct()
    running = join_on(stops, types, keys, how="inner")
    return with_scheduled_headway(running, [*feed, "day_type"])
