"""Timetable operators: headway, travel time, their means, and the direction lookups.

Nothing here gathers one trip, route or stop in a single task. Minima, maxima, counts
and sums are aggregated map-side before any shuffle; row-level results come from a
join back to those aggregates, which adaptive execution broadcasts when measured small
and splits when skewed. The one window runs over distinct seconds of the day of a
stop, so its groups are bounded by the clock, whatever the number of rows.

``feed`` names extra key columns (such as ``provider``) when one frame holds several
timetables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railpulse.functions import timecols

ROW_KEY = ("trip_id", "stop_sequence")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = (),
            how: str = "left", hot: bool = True) -> DataFrame:
    """Equi-join that keeps the left key columns; ``null_safe`` keys match null to null.

    The right side is mostly an aggregate on these very keys, and would join straight
    out of its aggregation. Adaptive execution can split a hot left key only if both
    sides come from a shuffle of their own; a hash of the keys as one more key asks for
    that, where the side is not broadcast, and gives the sort a number to start from.
    Keys that are never ``hot``, such as trips with their tens of stops, do without, and
    keep the partitioning that the aggregate has.
    """
    kinds, others = dict(left.dtypes), dict(right.dtypes)
    renamed = right.select(
        *[(F.col(k) if kinds[k] == others[k] else F.col(k).cast(kinds[k])).alias(f"_right_{k}")
          for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition: Column = F.xxhash64(*keys) == F.xxhash64(*[f"_right_{k}" for k in keys]) if hot else F.lit(True)
    for key in keys:
        lhs, rhs = F.col(key), F.col(f"_right_{key}")
        condition = condition & (lhs.eqNullSafe(rhs) if key in null_safe else lhs == rhs)
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def with_clock_times(stop_times: DataFrame, extended_hours: bool = False) -> DataFrame:
    """Arrival and departure text -> second of the day."""
    return stop_times.withColumns({
        c: timecols.clock_seconds(F.col(c), extended_hours)
        for c in ("arrival_time", "departure_time")
    })


def with_trips(stop_times: DataFrame, trips: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """Stop times with the route and direction of their trip, null where the trip is unknown."""
    wanted = trips.select(*feed, "trip_id", "route_id", "direction_id")
    return join_on(stop_times, wanted, [*feed, "trip_id"], hot=False)


def scheduled_stops(
    stop_times: DataFrame, trips: DataFrame, feed: Sequence[str] = (), extended_hours: bool = False
) -> DataFrame:
    """The loaded timetable: stop times, trips and clock times."""
    return with_trips(with_clock_times(stop_times, extended_hours), trips, feed)


def with_scheduled_headway(
    stops: DataFrame, feed: Sequence[str] = (), row_key: Sequence[str] = ROW_KEY
) -> DataFrame:
    """Seconds since the previous arrival of the same route, direction and stop.

    Only one row of a second has a gap to bridge; its peers arrive 0 s later. So the lag
    runs over the distinct seconds of a stop, and rows are joined back to their second.
    ``row_key`` says which row comes first within a second; the file position ``ord``,
    where the reader supplied one, tells repeated rows apart.

    Rows without arrival are not filtered out: they come first and leave the next gap
    null, and a filter would evaluate the clock parse a second time.
    """
    group = [*feed, "route_id", "direction_id", "stop_id"]
    position = [F.xxhash64("ord").alias("position")] if "ord" in stops.columns else []
    identity = F.struct(*row_key, *position)
    seconds = stops.groupBy(*group, "arrival_time").agg(F.min(identity).alias("_leader"))
    previous = F.lag("arrival_time").over(Window.partitionBy(*group).orderBy("arrival_time"))
    gaps = seconds.withColumn("_gap", F.col("arrival_time") - previous)
    joined = join_on(stops, gaps, [*group, "arrival_time"], null_safe=group)
    headway = F.when(
        F.col("arrival_time").isNotNull(),
        F.when(identity.eqNullSafe(F.col("_leader")), F.col("_gap")).otherwise(F.lit(0)),
    )
    return joined.withColumn("scheduled_headway", headway.cast("bigint")).drop("_gap", "_leader")


def trip_starts(stops: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """Earliest arrival of every trip."""
    return stops.groupBy(*feed, "trip_id").agg(F.min("arrival_time").alias("_start"))


def with_scheduled_travel_time(stops: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """Seconds since the earliest arrival of the trip."""
    keys = [*feed, "trip_id"]
    return _travel_time(join_on(stops, trip_starts(stops, feed), keys, null_safe=keys, hot=False))


def _travel_time(stops: DataFrame) -> DataFrame:
    elapsed = (F.col("arrival_time") - F.col("_start")).cast("bigint")
    return stops.withColumn("scheduled_tt", elapsed).drop("_start")


def _stops_with_start(
    stop_times: DataFrame, trips: DataFrame, feed: Sequence[str], extended_hours: bool
) -> DataFrame:
    """Route, direction and trip start in a single join of the large table."""
    keys = [*feed, "trip_id"]
    timed = with_clock_times(stop_times, extended_hours)
    per_trip = with_trips(trip_starts(timed, feed), trips, feed)
    return join_on(timed, per_trip, keys, null_safe=keys, hot=False)


def timetable_metrics(
    stop_times: DataFrame, trips: DataFrame, feed: Sequence[str] = (), extended_hours: bool = False
) -> DataFrame:
    """Timetable rows with headway and travel time."""
    stops = _stops_with_start(stop_times, trips, feed, extended_hours)
    return _travel_time(with_scheduled_headway(stops, feed))


def scheduled_metric_means(
    stop_times: DataFrame, trips: DataFrame, feed: Sequence[str] = (), extended_hours: bool = False
) -> DataFrame:
    """Mean headway and travel time per stop and direction, without row-level headways.

    Headways of a route, direction and stop add up to its last minus its first arrival,
    and there is one fewer of them than arrivals; so two hash aggregations replace the
    window and its sort, and the shuffled data is bounded by the number of stops.
    """
    stops = _stops_with_start(stop_times, trips, feed, extended_hours)
    return _means(stops.groupBy(*feed, "route_id", "direction_id", "stop_id").agg(*_arrival_sums()), feed)


def _arrival_sums() -> list[Column]:
    """Of the stops of a route and direction: what the means are made of."""
    arrival = F.col("arrival_time")
    return [
        F.count(arrival).alias("arrivals"),
        (F.max(arrival) - F.min(arrival)).cast("bigint").alias("span"),
        F.sum((arrival - F.col("_start")).cast("bigint")).alias("elapsed"),
    ]


def _means(per_route: DataFrame, feed: Sequence[str]) -> DataFrame:
    arrivals = F.sum("arrivals")
    gaps = F.sum(F.greatest(F.col("arrivals") - 1, F.lit(0)))
    return per_route.groupBy(*feed, "stop_id", "direction_id").agg(
        F.when(gaps > 0, F.sum("span") / gaps).alias("scheduled_headway"),
        F.when(arrivals > 0, F.sum("elapsed") / arrivals).alias("scheduled_tt"),
    )


def means_and_last_stop_directions(
    stop_times: DataFrame, trips: DataFrame, feed: Sequence[str] = (), extended_hours: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``scheduled_metric_means`` and ``direction_by_last_stop`` from one pass over the stop times.

    They are shuffled and sorted by trip once: windows add the start and the last stop of the
    trip, and the join with the trips finds them in place. Both results are read from the third,
    one row per stop that lists its routes and directions; a plan that has both computes it once.
    """
    trip = Window.partitionBy(*feed, "trip_id")
    place = F.struct("stop_sequence", "stop_id")
    timed = with_clock_times(stop_times, extended_hours).select(*feed, "trip_id", "stop_id", "stop_sequence", "arrival_time")
    placed = timed.select("*", F.min("arrival_time").over(trip).alias("_start"),
                          (place == F.max(place).over(trip)).alias("_last")).drop("stop_sequence")
    wanted = trips.select(*feed, "trip_id", "route_id", "direction_id", "ord", F.lit(True).alias("_known"))
    stops = join_on(placed, wanted, [*feed, "trip_id"], hot=False)
    ends = F.col("_last") & F.col("_known")
    per_route = stops.groupBy(*feed, "route_id", "direction_id", "stop_id").agg(
        *_arrival_sums(), F.count_if(ends).alias("ends"), F.min(F.when(ends, F.col("ord"))).alias("ord"))
    listed = per_route.groupBy(*feed, "stop_id").agg(F.collect_list(
        F.struct("direction_id", "arrivals", "span", "elapsed", "ends", "ord")).alias("routes"))
    routes = listed.select(*feed, "stop_id", F.inline("routes"))
    ended = routes.where((F.col("ends") > 0) & F.col("stop_id").isNotNull())
    return _means(routes, feed), _first_direction(
        ended.withColumnRenamed("stop_id", "headsign_stop_id"), [*feed, "headsign_stop_id"]), listed


def last_stop_per_trip(stop_times: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """Stop with the highest sequence number of every trip; equal numbers go by stop id."""
    last = F.max(F.struct("stop_sequence", "stop_id"))
    return stop_times.groupBy(*feed, "trip_id").agg(
        last.getField("stop_id").alias("headsign_stop_id")
    )


def direction_by_train_number(trips: DataFrame, feed: Sequence[str] = ()) -> DataFrame:
    """Direction of the first trip, in file order, of every train number."""
    return _first_direction(trips, [*feed, "trip_short_name"])


def direction_by_last_stop(
    trips: DataFrame, stop_times: DataFrame, feed: Sequence[str] = ()
) -> DataFrame:
    """Direction of the first trip, in file order, that ends at a stop."""
    ends = last_stop_per_trip(stop_times, feed)
    ended = join_on(trips, ends, [*feed, "trip_id"], hot=False).where(F.col("headsign_stop_id").isNotNull())
    return _first_direction(ended, [*feed, "headsign_stop_id"])


def _first_direction(trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``min_by`` keeps the value of the first row even when that value is null."""
    first = F.min_by("direction_id", "ord")
    return trips.groupBy(*keys).agg(first.alias("direction_id"))
