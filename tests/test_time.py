import datetime as dt

import pytest
from pyspark.sql import functions as F

from railpulse.functions import pathcols, timecols


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zoned(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("t"))).collect()]


def utc(text):
    return F.col("t").cast("timestamp_ntz") if text is None else text.cast("timestamp_ntz")


def test_iso(zoned):
    texts = ["2025-11-15T08:00:00-05:00", "2025-11-15T13:00:00Z", "2025-11-15T08:00:00-0500",
             "2025-11-15T13:00:00.000Z", "", None, "2025-13-01T00:00:00Z"]
    noon = dt.datetime(2025, 11, 15, 13)
    assert values(zoned, texts, timecols.parse_iso) == [noon, noon, noon, None, None, None, None]


def test_iso_around_clock_changes(zoned):
    """Moments that do not exist, or exist twice, on some local clock stay apart."""
    texts = ["2024-03-10T02:30:00Z", "2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z"]
    assert values(zoned, texts, lambda t: timecols.iso_text(timecols.parse_iso(t))) == [
        t.replace("Z", "+00:00") for t in texts]


def test_clock(spark):
    texts = ["06:05:00", "6:05:00", "23:59:59", "24:00:00", "25:10:00", "x", None, "10:60:00",
             "10:00:60", "10:00"]
    assert values(spark, texts, timecols.clock_seconds) == [
        21900, 21900, 86399, None, None, None, None, None, None, None]
    assert values(spark, texts, lambda t: timecols.clock_seconds(t, True)) == [
        21900, 21900, 86399, 86400, 90600, None, None, None, None, None]


def test_service_date(zoned):
    texts = ["2025-11-15 02:59:59", "2025-11-15 03:00:00", "2025-11-15 23:59:59", None]
    days = values(zoned, texts, lambda t: timecols.service_date(utc(t)))
    assert days == [dt.date(2025, 11, 14), dt.date(2025, 11, 15), dt.date(2025, 11, 15), None]


def test_service_date_eastern_when_clocks_fall_back(zoned):
    days = values(zoned, ["2025-11-02 07:30:00", "2025-11-02 08:00:00"],
                  lambda t: timecols.service_date(utc(t), zone=timecols.EASTERN))
    assert days == [dt.date(2025, 11, 1), dt.date(2025, 11, 2)]


def test_http_date(zoned):
    texts = ["Wed, 12 Nov 2025 10:00:00 GMT", "soon", None]
    assert values(zoned, texts, timecols.parse_http_date) == [
        dt.datetime(2025, 11, 12, 10), None, None]


def test_event_wall_clock(zoned):
    texts = ["2025-11-15T02:30:00+00:00", "2025-11-15T02:30:00Z", "2025-11-15T02:30:00-05:00",
             "2025-11-15T02:30:00.250000+00:00", "2024-03-10T02:30:00", "yesterday", None]
    half_past_two = dt.datetime(2025, 11, 15, 2, 30)
    assert values(zoned, texts, timecols.event_wall_clock) == [
        half_past_two] * 4 + [dt.datetime(2024, 3, 10, 2, 30), None, None]


def test_percent_of_nothing(spark):
    row = spark.range(1).select(timecols.percent(F.lit(0), F.lit(0)),
                                timecols.percent(F.lit(1), F.lit(4))).first()
    assert tuple(row) == (0.0, 25.0)


def test_stop_path_and_day(spark):
    rows = spark.createDataFrame([("NE R", None, "NYP"), ("NE R", 0, "NYP")],
                                 "r string, d int, s string")
    paths = rows.select(pathcols.stop_path(F.col("r"), F.col("d"), F.col("s"))).collect()
    assert [p[0] for p in paths] == ["NE R_None_NYP", "NE R_0_NYP"]
    day = spark.range(1).select(*pathcols.day_parts(F.lit(dt.date(2025, 1, 5))).values()).first()
    assert tuple(day) == (2025, 1, 5)
