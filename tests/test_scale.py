"""Plans that must hold on large and lopsided tables."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from railpulse.checks import views
from railpulse.checks.queries import QUERIES
from railpulse.functions import timecols
from railpulse.operators import enrich, timetable
from railpulse.plans import ingest
from railpulse.sources import raw_events, snapshots

WRITES_WHILE_BUILDING = {"event_stream", "cutoff_stream", "ingest_runs", "raw_event_store", "daily_store",
                         "daily_csv", "daily_store_concurrent", "collation_report", "service_day_slice", "snapshot_quarantine"}
LAZY = sorted(set(QUERIES) - WRITES_WHILE_BUILDING)


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_joins_and_no_python_rows(spark, sf001, name):
    plan = plan_of(QUERIES[name](spark, sf001))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
                 "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, node


@pytest.mark.parametrize("name", LAZY)
def test_joins_work_without_any_broadcast(spark, sf001, name):
    """Nothing forces a broadcast: with the size limit at nothing, none is planned."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert "BroadcastHashJoin" not in plan_of(QUERIES[name](spark, sf001))


def read_columns(plan, table):
    found = re.findall(rf"{table}\.parquet.*?ReadSchema: struct<(.*?)>", plan)
    return {c.split(":")[0] for c in ",".join(found).split(",")}


def test_scans_read_only_what_they_need(spark, sf001):
    plan = plan_of(QUERIES["scheduled_metric_means"](spark, sf001))
    assert read_columns(plan, "lineitem") <= {
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}
    assert read_columns(plan, "orders") == {
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"}


def test_raw_texts_are_parsed_once(spark, sf001):
    plan = plan_of(QUERIES["raw_events_valid"](spark, sf001))
    assert plan.count("from_json") == 1


def test_trips_join_without_a_hash_of_their_keys(spark, sf001):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert "xxhash64" not in plan_of(QUERIES["scheduled_travel_time"](spark, sf001))


def test_means_need_no_window(spark, sf001):
    assert "Window" not in plan_of(QUERIES["scheduled_metric_means"](spark, sf001))


def final_plan(df):
    df.collect()
    return plan_of(df)


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


def hot_stops(spark):
    """Half of the rows are one stop in one second of one route."""
    hot = F.col("id") % 2 == 0
    return spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("trip"), F.col("id").cast("string")).alias("trip_id"),
        F.lit(1).cast("bigint").alias("stop_sequence"),
        F.lit("R").alias("route_id"), F.lit(0).alias("direction_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string")))
        .alias("stop_id"),
        F.when(hot, 43200).otherwise((F.col("id") * 7 % 86400).cast("int")).alias("arrival_time"))


def test_hot_second_is_split_over_tasks(spark):
    with settings(spark, **SPLITTING):
        found = timetable.with_scheduled_headway(hot_stops(spark))
        assert "skew=true" in final_plan(found)
        assert found.where("stop_id = 'hot'").agg(
            F.count("*"), F.count("scheduled_headway"), F.sum("scheduled_headway")
        ).first()[:] == (30000, 29999, 0)


def test_hot_train_number_is_split_over_tasks(spark):
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "trainNumRaw"),
        F.lit(None).cast("string").alias("destCode"), F.md5(F.col("id").cast("string")).alias("pad"))
    by_number = rows.groupBy(F.col("trainNumRaw").alias("trip_short_name")).agg(
        F.lit(1).alias("direction_id"))
    by_stop = rows.groupBy(F.col("destCode").alias("headsign_stop_id")).agg(
        F.max(F.length("pad")).alias("direction_id"))
    with settings(spark, **SPLITTING):
        found = enrich.with_direction(rows, by_number, by_stop)
        assert "skew=true" in final_plan(found)
        assert found.groupBy("lookup_method").count().collect()[0][:] == ("primary", 60000)


def test_lookups_nobody_reads_are_not_built(spark, sf001):
    """Right sides are unique per key, so unused ones drop out of the plan."""
    assert "lineitem" not in plan_of(QUERIES["event_counts"](spark, sf001))


def test_keys_of_different_width_still_match(spark):
    left = spark.createDataFrame([(1, "a")], "k int, s string")
    right = spark.createDataFrame([(1, "a", "hit")], "k bigint, s string, v string")
    assert timetable.join_on(left, right, ["k", "s"]).first()["v"] == "hit"


def test_event_times_are_parsed_once_for_each_use(spark, sf001):
    """The raw day and the service day: filters on them copy neither parse."""
    plan = QUERIES["collate_same_day"](spark, sf001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[T ]") == 2


def test_rejected_documents_are_checked_once(spark, sf001):
    docs = spark.createDataFrame([(1, "{}"), (2, "[")], "document_id bigint, value string")
    rejected = snapshots.rejected_snapshots(snapshots.parse_snapshots(docs))
    assert rejected._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 1
    assert [r["document_id"] for r in rejected.collect()] == [2]


def test_both_ingest_runs_read_stored_documents(spark, sf001, monkeypatch):
    plans, run = [], ingest.run_ingest

    def watched(docs, *args, **options):
        plans.append(plan_of(docs))
        return run(docs, *args, **options)

    monkeypatch.setattr(ingest, "run_ingest", watched)
    QUERIES["ingest_runs"](spark, sf001)
    assert len(plans) == 2 and not any("to_json" in plan or "Aggregate" in plan for plan in plans)


def test_common_clock_times_are_read_by_places(spark):
    rows = spark.createDataFrame(
        [(t,) for t in ("07:05:09", "7:5:9", "23:59:59", "24:00:00", "07:05:09\n", "07:05:9x", "-7:05:09", None)], "t string")
    found = rows.select(timecols.clock_seconds(F.col("t")), timecols.clock_seconds(F.col("t"), True))
    assert [tuple(r) for r in found.collect()] == [
        (25509, 25509), (25509, 25509), (86399, 86399), (None, 86400), (25509, 25509), (None,) * 2, (None,) * 2, (None,) * 2]
    assert "substr" in found._jdf.queryExecution().optimizedPlan().toString()


def test_stop_times_are_scanned_once_for_all_timetable_tables(spark, sf001):
    plan = final_plan(QUERIES["event_generation"](spark, sf001)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan)) == 1


def test_texts_that_are_cut_off_are_not_parsed(spark):
    texts = ['{"trip_id":"a"}', ' [{"trip_id":"b"},\n {"trip_id":"c"}]\t', '[{"trip_id":"d"}', '{"trip_id":"e"} x',
             '{"trip_id":"f"},{"trip_id":"g"}', "[]", " ", "", None, '{"trip_id":"h"}]', "\r\n{\"trip_id\":\"i\"} "]
    docs = spark.createDataFrame([(t,) for t in texts], "value string")
    found = raw_events.parse_event_documents(docs)
    assert sorted(r["trip_id"] for r in found.collect()) == ["a", "b", "c", "i"]
    assert "EndsWith" in found._jdf.queryExecution().optimizedPlan().toString()


def test_fractions_are_dropped_without_decimal_remainders(spark):
    times = ["2024-01-15 07:05:09.999999", "1969-12-31 23:59:59.5", "2024-01-15 00:00:00", None]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz"))
    found = rows.select(timecols.whole_second(F.col("t")).cast("string"))
    assert [r[0] for r in found.collect()] == ["2024-01-15 07:05:09", "1969-12-31 23:59:59", "2024-01-15 00:00:00", None]
    assert "%" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_clock_texts_are_written_as_one_number(spark):
    rows = spark.createDataFrame([(s,) for s in (0, 59, 3600, 86399, 91858, 359999, None)], "s bigint")
    found = rows.select(views.clock_text(F.col("s")))
    assert [r[0] for r in found.collect()] == [
        "00:00:00", "00:00:59", "01:00:00", "23:59:59", "25:30:58", "99:59:59", ""]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lpad" not in plan and "double" not in plan
