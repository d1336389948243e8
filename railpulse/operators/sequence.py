"""Fill the stop sequence of events from the timetable: the call nearest in time.

A train number may call at a stop several times a day (loops, several trips under one
number). The planned call of an event is the one of its train and stop whose clock time is
nearest, across midnight too, and at most ``tolerance`` seconds away.

No range join: every planned call is dealt to its hour and both neighbours, so an event
finds all calls within an hour under one key. A key's calls are gathered as an array, after
equal seconds are reduced to their least sequence; so an array has at most 3 x 3,600
entries, however large the timetable, and events are joined once and never regrouped. A hot
train or stop is split on the events' side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.operators.timetable import join_on

DAY, HOUR = 86_400, 3_600


def _hour(second: Column) -> Column:
    return F.floor(F.pmod(second, F.lit(DAY)) / HOUR).cast("int")


def planned_calls(stops: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, hour of the day, and the calls that an event of that hour may belong to.

    ``stops`` has the keys, ``arrival_time`` as a second of the day (24:00 and later go on
    into the next day) and ``stop_sequence``; rows without any of them are no calls.
    """
    known = [*keys, "arrival_time", "stop_sequence"]
    second = F.pmod(F.col("arrival_time").cast("int"), F.lit(DAY))
    calls = (stops.select(*known).dropna().withColumn("arrival_time", second)
             .groupBy(*keys, "arrival_time").agg(F.min("stop_sequence").alias("stop_sequence")))
    around = F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]),
                         lambda d: F.pmod(_hour(F.col("arrival_time")) + d, F.lit(24)).cast("int"))
    return (calls.withColumn("_hour", F.explode(around)).groupBy(*keys, "_hour")
            .agg(F.collect_list(F.struct("arrival_time", "stop_sequence")).alias("_calls")))


def with_stop_sequence(events: DataFrame, stops: DataFrame, keys: Sequence[str], second: str,
                       tolerance: int = HOUR) -> DataFrame:
    """Events with ``stop_sequence``, ``planned_time`` and ``off_plan`` (seconds after the plan).

    ``second`` names the events' second of the day on the timetable's clock. All three are null
    for events without time or key, and where no call is near enough. Of two calls equally far
    the earlier clock time counts; of trips that call in the same second the least sequence.
    Row counts never change; columns of these names that events have already are replaced.
    """
    if not 0 <= tolerance <= HOUR:
        raise ValueError(f"tolerance must be 0 to {HOUR} seconds")
    added = ("stop_sequence", "planned_time", "off_plan")
    timed = events.drop(*added).withColumn("_hour", _hour(F.col(second)))
    joined = join_on(timed, planned_calls(stops, keys), [*keys, "_hour"])

    def candidate(call: Column) -> Column:
        late = F.pmod(F.col(second) - call["arrival_time"] + DAY // 2, F.lit(DAY)) - DAY // 2
        return F.struct(F.abs(late).alias("far"), call["arrival_time"].alias("planned_time"),
                        call["stop_sequence"].alias("stop_sequence"), late.alias("off_plan"))

    nearest = joined.withColumn("_nearest", F.array_min(F.transform("_calls", candidate)))
    near = F.col("_nearest.far") <= tolerance
    return nearest.withColumns(
        {c: F.when(near, F.col(f"_nearest.{c}")) for c in added}).drop("_hour", "_calls", "_nearest")
