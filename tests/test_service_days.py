import datetime as dt

from pyspark.sql import functions as F

from railpulse.operators import service_days

CALENDAR = "service_id string, " + "".join(f"{d} int, " for d in service_days.WEEKDAYS) + "start_date date, end_date date"
EXCEPTIONS = "service_id string, date date, exception_type int"
STOPS = ("trip_id string, stop_sequence bigint, route_id string, direction_id int, stop_id string, "
         "arrival_time int, service_id string")


def day(n):
    return dt.date(2024, 1, n)  # the first is a Monday


def days_of(spark, calendar, exceptions):
    return service_days.active_days(spark.createDataFrame(calendar, CALENDAR),
                                    spark.createDataFrame(exceptions, EXCEPTIONS))


WORK, REST, NEVER = (1, 1, 1, 1, 1, 0, 0), (0, 0, 0, 0, 0, 1, 1), (0,) * 7


def test_patterns_and_exceptions(spark):
    found = days_of(spark, [("w", *WORK, day(4), day(9)), ("w", *WORK, day(8), day(9)), ("n", *NEVER, day(1), day(9)),
                            ("r", *REST, day(9), day(1)), ("u", *WORK, None, day(9))],
                    [("w", day(5), 2), ("w", day(6), 1), ("n", day(7), 1), ("n", day(7), 1), ("n", day(8), 1),
                     ("n", day(8), 2), (None, day(1), 1), ("x", None, 1)])
    assert sorted((r["service_id"], r["service_day"].day) for r in found.collect()) == [
        ("n", 7), ("w", 4), ("w", 6), ("w", 8), ("w", 9)]


def test_headways_only_among_trips_of_a_day(spark):
    days = days_of(spark, [("all", *(1,) * 7, day(1), day(14)), ("w", *WORK, day(1), day(14))], [("w", day(3), 2)])
    types = {r["service_day"].day: r["day_type"].day for r in service_days.day_types(days).collect()}
    assert types == {n: 3 if n in (3, 6, 7, 13, 14) else 1 for n in range(1, 15)}
    stops = spark.createDataFrame(
        [("a", 1, "R", 0, "S", 100, "all"), ("b", 1, "R", 0, "S", 160, "w"), ("c", 1, "R", 0, "S", 400, "all"),
         ("d", 1, "R", 0, "S", 500, "gone"), ("e", 1, "R", 0, "S", 500, None)], STOPS).withColumn("x", F.lit(1))
    rows = service_days.with_headway_by_day_type(stops, days).collect()
    assert sorted((r["day_type"].day, r["trip_id"], str(r["scheduled_headway"])) for r in rows) == [
        (1, "a", "None"), (1, "b", "60"), (1, "c", "240"), (3, "a", "None"), (3, "c", "300")]


def test_empty_tables(spark):
    days = days_of(spark, [], [])
    assert service_days.day_types(days).count() == 0
    assert service_days.with_headway_by_day_type(spark.createDataFrame([], STOPS), days).count() == 0
