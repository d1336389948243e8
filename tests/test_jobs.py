"""The jobs one after the other, as a scheduler would run them."""

import datetime as dt
import json

import pytest

from railpulse import jobs
from railpulse.sinks.stores import read_daily_table
from tests.test_snapshots import TRAIN
from tests.test_stream import MORNING, NOON, land, snapshot


def test_from_bundle_to_daily_events(spark, tmp_path):
    bundle, landing = tmp_path / "bundle", tmp_path / "landing"
    bundle.mkdir()
    (bundle / "trips.txt").write_text(
        "trip_id,route_id,direction_id,trip_short_name\n1,R,0,7\n2,R,0,7\n")
    (bundle / "stop_times.txt").write_text(
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
        "1,08:00:00,08:01:00,WAS,1\n1,09:00:00,09:01:00,NYP,2\n"
        "2,09:00:00,09:01:00,WAS,1\n2,10:30:00,10:31:00,NYP,2\n")
    land(landing, "a.json", snapshot(MORNING, NOON))
    assert TRAIN["trainNumRaw"] == "7"
    path = {name: str(tmp_path / name) for name in (
        "tables", "raw", "state", "daily", "csv", "manifest", "headers")}

    jobs.main(["timetable", "--bundle", f"Amtrak={bundle}", "--tables", path["tables"]])
    report = json.loads(jobs.main(
        ["ingest", "--landing", str(landing), "--tables", path["tables"], "--raw", path["raw"],
         "--state", path["state"]]))
    assert report["events"]["departures"] == report["events"]["events_amtrak"] == 2
    assert report["funnel"]["station_rows"] == 2
    assert report["directions"]["primary_hits"] == 2

    today = dt.datetime.now(dt.timezone.utc).date()
    arguments = ["collate", "--raw", path["raw"], "--table", path["daily"], "--csv", path["csv"]]
    none = json.loads(jobs.main(arguments + ["--first", "2025-11-15", "--provider", "VIA", "amtrak"]))
    assert none["events_count"] == none["events_read"] == 0
    assert none["missing_days"] == [["Amtrak", "2025-11-15"], ["Via", "2025-11-15"]]
    # The events were processed today, long after their service day: today's run names it.
    late = json.loads(jobs.main(arguments + ["--first", today.isoformat()]))
    assert late["events_read"] == 2 and late["events_count"] == 0
    assert late["left_out"] == [{"provider": "Amtrak", "left_out": "other_day",
                                 "service_day": "2025-11-15", "events_count": 2}]
    days = (today - dt.date(2025, 11, 15)).days
    found = json.loads(jobs.main(arguments + ["--first", "2025-11-15", "--late-days", str(days)]))
    assert (found["events_count"], found["files_uploaded"]) == (2, 1)
    stored = read_daily_table(spark, path["daily"]).collect()
    assert {(r["stop_path"], r["scheduled_headway"], r["scheduled_tt"]) for r in stored} == {
        ("NE R_0_NYP", 5400, 4500)}

    (tmp_path / "headers").write_text(
        '{"agency": "A", "last_modified": "Wed, 12 Nov 2025 10:00:00 GMT"}\n')
    refresh = ["refresh", "--headers", path["headers"], "--manifest", path["manifest"]]
    assert json.loads(jobs.main(refresh)) == ["A"]
    assert json.loads(jobs.main(refresh)) == []


def test_stream_job_and_layouts(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", snapshot(MORNING, NOON))
    from tests.test_events import tables

    built = tables(spark)
    feeds = type(built)(*[t.selectExpr("'Amtrak' as provider", "*") for t in (
        built.means, built.by_train_number, built.by_last_stop)], ("provider",))
    path = {name: str(tmp_path / name) for name in ("tables", "raw", "state", "check", "daily", "events", "check2")}
    feeds.save(path["tables"])
    common = ["stream", "--landing", str(landing), "--tables", path["tables"], "--once"]
    assert json.loads(jobs.main([*common, "--raw", path["raw"], "--checkpoint", path["check"],
                                 "--state", path["state"]]))["batches"] == 1
    jobs.main([*common, "--raw", path["events"], "--checkpoint", path["check2"], "--dedupe"])
    today = dt.datetime.now(dt.timezone.utc).date()
    for raw, layout, first in ((path["raw"], "own", today), (path["events"], "stream", dt.date(2025, 11, 15))):
        found = json.loads(jobs.main(["collate", "--raw", raw, "--table", path["daily"], "--layout", layout,
                                      "--first", first.isoformat()]))
        assert found["events_read"] == 2, layout


def test_unknown_providers_are_refused():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["collate", "--raw", "r", "--table", "t", "--provider", "Nobody"])
