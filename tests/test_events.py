import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from railpulse.operators import events, quality
from railpulse.plans import ingest
from railpulse.schemas import EVENT_COLUMNS

STOP = ("routeName string, trainNumRaw string, destCode string, provider string, code string, "
        "bus boolean, status string, arr timestamp_ntz, dep timestamp_ntz, direction_id int, "
        "scheduled_headway bigint, scheduled_tt bigint")
ARR, DEP = dt.datetime(2025, 11, 15, 2, 59, 59), dt.datetime(2025, 11, 15, 3, 0)


def stop(number, arr, dep, provider="Amtrak", dest="BOS", code="NYP", bus=False,
         status="Departed"):
    return ("NE R", number, dest, provider, code, bus, status, arr, dep, 1, 60, 120)


def test_up_to_two_events_per_stop(spark):
    rows = spark.createDataFrame(
        [stop("1", ARR, DEP), stop("2", ARR, None), stop("3", None, DEP), stop("4", None, None)],
        STOP)
    found = events.arr_dep_events(rows)
    assert found.columns == ["provider", *EVENT_COLUMNS]
    assert Counter(r["trip_id"] for r in found.collect()) == Counter({"1": 2, "2": 1, "3": 1})
    first = found.where("trip_id = '1'").orderBy("event_type").collect()
    assert first[0].asDict() == {
        "provider": "Amtrak", "service_date": "2025-11-14", "route_id": "NE R", "trip_id": "1",
        "direction_id": 1, "stop_id": "NYP", "stop_sequence": None, "vehicle_id": "1",
        "vehicle_label": "1", "event_type": "ARR", "event_time": "2025-11-15T02:59:59+00:00",
        "scheduled_headway": 60, "scheduled_tt": 120}
    assert (first[1]["service_date"], first[1]["event_time"]) == (
        "2025-11-15", "2025-11-15T03:00:00+00:00")
    assert tuple(events.event_counts(found).first()) == ("Amtrak", 2, 2, 4)


def test_one_scan_for_both_kinds(spark):
    rows = spark.createDataFrame([stop("1", ARR, DEP)], STOP)
    plan = events.arr_dep_events(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Exchange" not in plan


def test_dedupe_keys(spark):
    later = ARR + dt.timedelta(minutes=-1)
    rows = spark.createDataFrame(
        [stop("1", ARR, None), stop("1", ARR, None), stop("1", later, None)], STOP)
    found = events.arr_dep_events(rows)
    assert events.dedupe_events(found).count() == 2
    visit = ("provider", "trip_id", "stop_id", "event_type", "service_date")
    assert events.dedupe_events(found, visit).count() == 1


def test_dedupe_keeps_the_earliest_landed(spark):
    rows = spark.createDataFrame([stop("1", ARR, None)], STOP)
    late = events.arr_dep_events(rows).withColumns({
        "landed_at": F.lit("2025-01-02").cast("date"), "scheduled_tt": F.lit(5).cast("bigint")})
    early = late.withColumns({
        "landed_at": F.lit("2025-01-01").cast("date"), "scheduled_tt": F.lit(9).cast("bigint")})
    for both in (late.unionAll(early), early.unionAll(late)):
        assert [r["scheduled_tt"] for r in events.dedupe_events(both).collect()] == [9]


def tables(spark):
    means = spark.createDataFrame(
        [("NYP", 0, 59.5, 10.0), ("NYP", 1, 600.0, 20.0)],
        "stop_id string, direction_id int, scheduled_headway double, scheduled_tt double")
    by_number = spark.createDataFrame([("1", 0)], "trip_short_name string, direction_id int")
    by_stop = spark.createDataFrame([("BOS", 1)], "headsign_stop_id string, direction_id int")
    return ingest.TimetableTables(means, by_number, by_stop)


def test_generation_picks_enabled_providers_and_their_lookups(spark):
    rows = spark.createDataFrame(
        [stop("1", ARR, None), stop("2", ARR, None, "Via"),
         stop("1", ARR, None, "Brightline", "WPT"), stop("1", ARR, None, "Brightline", "MIA")],
        STOP).drop("direction_id", "scheduled_headway", "scheduled_tt")

    def summary(**options):
        found = ingest.generate_events(rows, tables(spark), **options).collect()
        return Counter((r["provider"], r["direction_id"], r["scheduled_headway"]) for r in found)

    default = Counter([("Amtrak", 0, 60), ("Via", 1, 600)])
    assert summary() == default
    third = Counter([("Brightline", 1, 600), ("Brightline", None, None)])
    assert summary(enabled=("Amtrak", "Via", "Brightline")) == default + third


def test_empty_input_keeps_the_columns(spark):
    none = spark.createDataFrame([], STOP).drop(
        "direction_id", "scheduled_headway", "scheduled_tt")
    found = ingest.generate_events(none, tables(spark))
    assert found.columns == ["provider", *EVENT_COLUMNS] and found.count() == 0


def test_tables_survive_storage(spark, tmp_path):
    kept = tables(spark)
    kept.save(str(tmp_path / "dims"))
    loaded = ingest.TimetableTables.load(spark, str(tmp_path / "dims"))
    assert Counter(loaded.means.collect()) == Counter(kept.means.collect())


def test_funnel(spark):
    rows = spark.createDataFrame(
        [stop("1", ARR, DEP), stop("1", ARR, None), stop("1", ARR, DEP, "Via", bus=True),
         stop("1", ARR, DEP, "Via"), stop("1", ARR, DEP, "Metro"),
         stop("1", ARR, DEP, status="Enroute")], STOP)
    assert tuple(quality.ingest_funnel(rows).first()) == (6, 6, 4, 2, 1, 0)
    assert tuple(quality.ingest_funnel(rows, "2025-11-15 00:00:00").first()) == (6, 5, 3, 1, 1, 0)


def test_missing_days(spark):
    expected = quality.expected_days(
        spark, dt.date(2025, 1, 1), dt.date(2025, 1, 3), ["Amtrak", "Via"])
    seen = spark.createDataFrame(
        [("Amtrak", dt.date(2025, 1, 1))] * 5 + [("Via", dt.date(2025, 1, d)) for d in (1, 2, 3)],
        "provider string, day date")
    found = quality.missing_days(expected, seen).collect()
    assert {(r["provider"], r["day"].day) for r in found} == {("Amtrak", 2), ("Amtrak", 3)}
