import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from railpulse.operators import enrich, timetable

STOPS = ("trip_id string, stop_sequence bigint, route_id string, direction_id int, "
         "stop_id string, arrival_time int")


def stops(spark, rows):
    return spark.createDataFrame(rows, STOPS)


def headways(frame, key="trip_id"):
    return {r[key]: r["scheduled_headway"] for r in frame.collect()}


def test_headway_null_comes_first_and_ties_are_zero(spark):
    rows = [(t, 1, "R", 0, "S", a) for t, a in
            [("a", None), ("b", 100), ("c", 160), ("d", 160)]]
    found = headways(timetable.with_scheduled_headway(stops(spark, rows)))
    assert found == {"a": None, "b": None, "c": 60, "d": 0}


def test_headway_matches_null_keys_with_each_other(spark):
    rows = [("a", 1, None, None, "S", 10), ("b", 1, None, None, "S", 30),
            ("c", 1, "R", None, "S", 50)]
    found = headways(timetable.with_scheduled_headway(stops(spark, rows)))
    assert found == {"a": None, "b": 20, "c": None}


def test_headway_of_repeated_rows_with_file_order(spark):
    """Copies of a row: one carries the gap, the others follow at once."""
    rows = [("a", 1, "R", 0, "S", 10)] + [("b", 1, "R", 0, "S", 40)] * 3
    frame = stops(spark, rows).coalesce(1).withColumn("n", F.monotonically_increasing_id())
    saved = spark.createDataFrame(frame.collect(), frame.schema).withColumnRenamed("n", "ord")
    found = timetable.with_scheduled_headway(saved).collect()
    assert Counter(r["scheduled_headway"] for r in found) == Counter({None: 1, 30: 1, 0: 2})


def test_travel_time(spark):
    rows = [("t", 1, "R", 0, "A", 100), ("t", 2, "R", 0, "B", None), ("t", 3, "R", 0, "C", 400)]
    found = timetable.with_scheduled_travel_time(stops(spark, rows)).collect()
    assert {r["stop_id"]: r["scheduled_tt"] for r in found} == {"A": 0, "B": None, "C": 300}


def brute_force(rows):
    """Both metrics by the definition, one group at a time; ties as multisets."""
    groups, starts = {}, {}
    for trip, _, route, direction, stop, arrival in rows:
        groups.setdefault((route, direction, stop), []).append(arrival)
        if arrival is not None:
            starts[trip] = min(arrival, starts.get(trip, arrival))
    headway = Counter()
    for key, arrivals in groups.items():
        ordered = sorted(arrivals, key=lambda a: (a is not None, a or 0))
        for before, here in zip([None] + ordered, ordered):
            gap = None if before is None or here is None else here - before
            headway[(*key, here, gap)] += 1
    travel = Counter((t, a, None if a is None else a - starts[t]) for t, _, _, _, _, a in rows)
    return headway, travel


def skewed_rows(seed, n=3000):
    """A third of the rows in one stop and trip, and a third of those in one second."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        trip = "hot" if hot else f"t{rng.randrange(300)}"
        stop = "hot" if hot else f"s{rng.randrange(20)}"
        route = "R0" if hot else rng.choice(["R0", "R1", None])
        direction = 0 if hot else rng.choice([0, 1, None])
        arrival = 43200 if hot and rng.random() < 1 / 3 else rng.choice(
            [None, rng.randrange(86400), rng.randrange(600)])
        rows.append((trip, i, route, direction, stop, arrival))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_against_brute_force_on_skewed_rows(spark, seed):
    rows = skewed_rows(seed)
    frame = stops(spark, rows)
    headway, travel = brute_force(rows)
    gaps = timetable.with_scheduled_headway(frame).select(
        "route_id", "direction_id", "stop_id", "arrival_time", "scheduled_headway")
    assert Counter(map(tuple, gaps.collect())) == headway
    elapsed = timetable.with_scheduled_travel_time(frame).select(
        "trip_id", "arrival_time", "scheduled_tt")
    assert Counter(map(tuple, elapsed.collect())) == travel


def timetable_frames(spark, provider=None):
    rng = random.Random(7)
    trips = [(f"t{i}", f"r{i % 3}", rng.choice([0, 1, None]), str(i % 10), i) for i in range(60)]
    times = [(f"t{rng.randrange(70)}", f"{rng.randrange(27):02d}:{rng.randrange(60):02d}:00",
              f"s{rng.randrange(8)}", i) for i in range(900)]
    trips_df = spark.createDataFrame(
        trips, "trip_id string, route_id string, direction_id int, trip_short_name string, ord int")
    times_df = spark.createDataFrame(
        times, "trip_id string, arrival_time string, stop_id string, stop_sequence bigint"
    ).withColumn("departure_time", F.col("arrival_time"))
    if provider:
        return (times_df.withColumn("provider", F.lit(provider)),
                trips_df.withColumn("provider", F.lit(provider)))
    return times_df, trips_df


def as_map(frame, *keys):
    rest = [c for c in frame.columns if c not in keys]
    return {tuple(r[k] for k in keys): tuple(r[c] for c in rest) for r in frame.collect()}


def test_means_equal_means_of_row_level_metrics(spark):
    times, trips = timetable_frames(spark)
    direct = timetable.scheduled_metric_means(times, trips)
    by_rows = timetable.timetable_metrics(times, trips).groupBy("stop_id", "direction_id").agg(
        F.avg("scheduled_headway").alias("scheduled_headway"), F.avg("scheduled_tt").alias("scheduled_tt"))
    ours, theirs = (as_map(f, "stop_id", "direction_id") for f in (direct, by_rows))
    assert ours.keys() == theirs.keys()
    for key, values in ours.items():
        assert values == pytest.approx(theirs[key]) if None not in values else (
            values == theirs[key])


def test_fused_metrics_equal_single_operators(spark):
    times, trips = timetable_frames(spark)
    loaded = timetable.scheduled_stops(times, trips)
    apart = timetable.with_scheduled_travel_time(timetable.with_scheduled_headway(loaded))
    fused = timetable.timetable_metrics(times, trips)
    columns = sorted(apart.columns)
    assert Counter(map(tuple, fused.select(columns).collect())) == Counter(
        map(tuple, apart.select(columns).collect()))
    assert loaded.count() == times.count()


def test_several_feeds_in_one_frame(spark):
    """Two providers share ids; each keeps its own metrics and lookups."""
    one = timetable_frames(spark, "A")
    other = timetable_frames(spark, "B")
    later = other[0].withColumn("stop_id", F.concat(F.lit("x"), "stop_id"))
    times, trips = one[0].unionByName(later), one[1].unionByName(other[1])
    feed = ["provider"]
    alone = timetable.scheduled_metric_means(*timetable_frames(spark))
    both = timetable.scheduled_metric_means(times, trips, feed)
    assert as_map(both.where("provider = 'A'").drop("provider"), "stop_id", "direction_id") == (
        as_map(alone, "stop_id", "direction_id"))
    assert timetable.direction_by_train_number(trips, feed).count() == 20
    ends = timetable.direction_by_last_stop(trips, times, feed)
    assert ends.where("provider = 'B'").where("headsign_stop_id like 'x%'").count() == (
        ends.where("provider = 'A'").count())


def test_keep_first_direction_even_when_null(spark):
    trips = spark.createDataFrame(
        [("k", None, 1), ("k", 1, 2), ("m", 0, 4), ("m", 1, 3)],
        "trip_short_name string, direction_id int, ord bigint")
    found = as_map(timetable.direction_by_train_number(trips), "trip_short_name")
    assert found == {("k",): (None,), ("m",): (1,)}


def test_last_stop(spark):
    times = spark.createDataFrame(
        [("t", "A", 1), ("t", "B", 10), ("t", "C", 9), ("u", "Z", None)],
        "trip_id string, stop_id string, stop_sequence bigint")
    assert as_map(timetable.last_stop_per_trip(times), "trip_id") == {
        ("t",): ("B",), ("u",): ("Z",)}


def test_extended_hours_keep_times_past_midnight(spark):
    times, trips = timetable_frames(spark)
    kept = timetable.scheduled_stops(times, trips, extended_hours=True)
    late = kept.where("arrival_time >= 86400").count()
    assert late > 0
    parity = timetable.scheduled_stops(times, trips)
    assert parity.where("arrival_time is null").count() == late


STATION = "trainNumRaw string, destCode string, provider string"


def lookups(spark):
    by_number = spark.createDataFrame(
        [("1", 0), ("2", None)], "trip_short_name string, direction_id int")
    by_stop = spark.createDataFrame(
        [("X", 1), ("Y", None)], "headsign_stop_id string, direction_id int")
    return by_number, by_stop


def test_two_stage_direction(spark):
    rows = [("1", "X", "Amtrak"), ("2", "X", "Amtrak"), ("3", "X", "Via"), ("3", "Y", "Via"),
            (None, None, "Via")]
    found = enrich.with_direction(spark.createDataFrame(rows, STATION), *lookups(spark))
    assert Counter((r["trainNumRaw"], r["destCode"], r["direction_id"], r["lookup_method"])
                   for r in found.collect()) == Counter([
        ("1", "X", 0, "primary"), ("2", "X", 1, "secondary"), ("3", "X", 1, "secondary"),
        ("3", "Y", None, None), (None, None, None, None)])
    stats = enrich.direction_match_stats(found).first()
    assert tuple(stats) == (1, 2, 2, 60.0)


def test_headsign_direction(spark):
    rows = spark.createDataFrame([(c,) for c in ["EKW", "MCO", "WPT", "MIA", None]],
                                 "destCode string")
    from railpulse.schemas import BRIGHTLINE_HEADSIGNS
    found = enrich.with_headsign_direction(rows, BRIGHTLINE_HEADSIGNS)
    assert [r["direction_id"] for r in found.collect()] == [1, 0, 1, None, None]
    assert dict(found.dtypes)["direction_id"] == "int"


def test_means_round_half_to_even(spark):
    means = spark.createDataFrame(
        [("A", 0, 2.5, 3.5), ("B", 0, -0.5, None)],
        "stop_id string, direction_id int, scheduled_headway double, scheduled_tt double")
    rows = spark.createDataFrame(
        [("A", 0), ("B", 0), ("A", None)], "code string, direction_id int")
    found = enrich.with_scheduled_metrics(rows, means)
    assert Counter((r["code"], r["scheduled_headway"], r["scheduled_tt"])
                   for r in found.collect()) == Counter(
        [("A", 2, 4), ("B", 0, None), ("A", None, None)])
    assert tuple(enrich.metric_match_stats(found).first()) == (2, 1, pytest.approx(200 / 3))


def test_tables_of_one_pass_equal_those_of_single_operators(spark):
    """Also for stops and trips without an id, unknown, unused and repeated trips, and equal last stops."""
    stop_times = spark.range(0, 4000).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("A"), (F.col("id") % 2).cast("string"))).alias("provider"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("t"), (F.col("id") * 31 % 300).cast("string"))).alias("trip_id"),
        F.when(F.col("id") % 13 != 0, F.concat(F.lit("s"), (F.col("id") * 17 % 9).cast("string"))).alias("stop_id"),
        F.when(F.col("id") % 17 != 0, F.col("id") * 7 % 5).alias("stop_sequence"),
        F.format_string("%02d:%02d:00", F.col("id") * 3 % 26, F.col("id") * 11 % 60).alias("arrival_time")
    ).withColumn("departure_time", F.col("arrival_time"))
    trips = spark.range(0, 520).select(
        F.concat(F.lit("A"), (F.col("id") % 3).cast("string")).alias("provider"),
        F.when(F.col("id") % 19 != 0, F.concat(F.lit("t"), (F.col("id") % 400).cast("string"))).alias("trip_id"),
        F.concat(F.lit("r"), (F.col("id") % 4).cast("string")).alias("route_id"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 2).cast("int")).alias("direction_id"),
        (1000 - F.col("id")).alias("ord"))
    for feed in ([], ["provider"]):
        means, by_last_stop, _ = timetable.means_and_last_stop_directions(stop_times, trips, feed)
        for found, single in ((means, timetable.scheduled_metric_means(stop_times, trips, feed)),
                              (by_last_stop, timetable.direction_by_last_stop(trips, stop_times, feed))):
            rows = sorted(map(str, found.select(single.columns).collect()))
            assert rows and rows == sorted(map(str, single.collect()))
