"""Known sums over the sf0.01 tables, found earlier with two other engines."""

import pytest
from pyspark.sql import functions as F

from railpulse.checks import views
from railpulse.operators import enrich, events, filters
from railpulse.plans import collate
from railpulse.plans.ingest import TimetableTables


@pytest.fixture(scope="module")
def tables(spark, sf001):
    """Timetable where one trip in thirteen is unknown, unlike the registered view."""
    orders = views.table(spark, sf001, "orders").where(F.col("o_orderkey") % 13 != 0)
    trips = orders.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_orderpriority").alias("route_id"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey") % 2).cast("int").alias(
            "direction_id"),
        (F.col("o_custkey") % 60 * 2).cast("string").alias("trip_short_name"),
        F.col("o_orderkey").alias("ord"))
    return TimetableTables.build(views.stop_times(spark, sf001), trips)


@pytest.fixture(scope="module")
def enriched(spark, sf001, tables):
    rows = filters.departed_rail(views.station_rows(spark, sf001))
    directed = enrich.with_direction(rows, tables.by_train_number, tables.by_last_stop)
    return enrich.with_scheduled_metrics(directed, tables.means).cache()


def test_directions(enriched):
    found = {r["lookup_method"]: (r["n"], r["total"]) for r in enriched.groupBy(
        "lookup_method").agg(F.count("*").alias("n"), F.sum("direction_id").alias("total")).collect()}
    assert found == {None: (593, None), "primary": (2203, 1118), "secondary": (3208, 1446)}


def test_means(tables):
    def total(rounded):
        columns = [F.sum(rounded(F.col(c), 0)).cast("bigint") for c in (
            "scheduled_headway", "scheduled_tt")]
        return tuple(tables.means.agg(*columns).first())

    assert tables.means.count() == 120
    assert total(F.bround) == (147438, 451387)
    assert total(F.round)[0] == 147439


def test_enriched(enriched):
    assert tuple(enriched.agg(
        F.count("*"), F.count("scheduled_headway"), F.sum("scheduled_headway"),
        F.sum("scheduled_tt")).first()) == (6004, 4826, 3197690, 18145677)


def test_events_and_service_days(enriched):
    found = events.arr_dep_events(enriched)
    shifted = F.col("service_date") != F.col("event_time").substr(1, 10)
    counts = {r[0]: tuple(r[1:]) for r in found.groupBy("event_type").agg(
        F.count("*"), F.count_if(shifted)).collect()}
    assert counts == {"ARR": (5458, 652), "DEP": (5684, 676)}
    groups = collate.daily_events(found).select("provider", "stop_path", "service_day")
    assert groups.distinct().count() == 5741
