import datetime as dt
import json
from collections import Counter

from railpulse.checks import queries
from railpulse.plans import ingest
from railpulse.sources import raw_events, snapshots, state
from railpulse.streaming import ingest_stream
from tests.test_events import tables
from tests.test_snapshots import TRAIN


def snapshot(*departures, code="NYP"):
    stations = [{**TRAIN["stations"][0], "code": code, "arr": None, "dep": d} for d in departures]
    return json.dumps({"7": [{**TRAIN, "stations": stations}]}, indent=1)


def land(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


MORNING, NOON, LATER = "2025-11-15T08:00:00Z", "2025-11-15T12:00:00Z", "2035-11-15T13:00:00Z"


def test_event_stream_reports_each_event_once(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", snapshot(MORNING, NOON))
    land(landing, "b.json", snapshot(MORNING, NOON)[:-2])

    def run():
        docs = snapshots.stream_snapshots(spark, str(landing))
        found = ingest_stream.first_reports(ingest_stream.event_stream(docs, tables(spark)))
        ingest_stream.write_event_stream(
            found, str(tmp_path / "events"), str(tmp_path / "check"), once=True).awaitTermination()
        stored = spark.read.parquet(str(tmp_path / "events"))
        return Counter(r["event_time"] for r in stored.collect())

    first = {"2025-11-15T08:00:00+00:00": 1, "2025-11-15T12:00:00+00:00": 1}
    assert run() == first
    land(landing, "c.json", snapshot(NOON, "2025-11-15T12:30:00Z"))
    assert run() == {**first, "2025-11-15T12:30:00+00:00": 1}
    assert run() == {**first, "2025-11-15T12:30:00+00:00": 1}


def test_cutoff_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    raw, cutoff = str(tmp_path / "raw"), str(tmp_path / "cutoff")

    def run():
        docs = snapshots.stream_snapshots(spark, str(landing))
        ingest_stream.start_cutoff_ingest(
            docs, tables(spark), raw, cutoff, str(tmp_path / "check"), once=True
        ).awaitTermination()
        return Counter(
            r["event_time"] for r in raw_events.read_raw_events(spark, raw).collect())

    land(landing, "a.json", snapshot(MORNING, NOON))
    land(landing, "b.json", snapshot(NOON))
    first = {"2025-11-15T08:00:00+00:00": 1, "2025-11-15T12:00:00+00:00": 1}
    assert run() == first
    moved = state.read_cutoff(spark, cutoff)
    assert moved is not None
    land(landing, "c.json", snapshot(NOON, LATER))
    assert run() == {**first, "2035-11-15T13:00:00+00:00": 1}
    assert state.read_cutoff(spark, cutoff) >= moved


def test_batch_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", snapshot(MORNING, NOON))
    raw, cutoff = str(tmp_path / "raw"), str(tmp_path / "cutoff")
    docs = snapshots.read_snapshots(spark, str(landing))
    now = dt.datetime(2025, 11, 15, 10, tzinfo=dt.timezone.utc)
    report = ingest.run_ingest(docs, tables(spark), raw, cutoff, now=now)
    assert report.cutoff == now
    assert report.events == {"arrivals": 0, "departures": 2, "events_amtrak": 2, "events_via": 0,
                             "events_brightline": 0}
    assert report.snapshots == {"documents": 1, "rejected": 0, "trains": 1}
    assert report.funnel["station_rows"] == report.funnel["rows_after_bus_removal"] == 2
    assert report.directions == {
        "primary_hits": 0, "secondary_hits": 2, "misses": 0, "match_rate_pct": 100.0}
    assert report.metrics == {"metrics_found": 2, "metrics_missing": 0, "match_rate_pct": 100.0}
    assert raw_events.read_raw_events(spark, raw).count() == 2
    ingest.run_ingest(docs, tables(spark), raw, cutoff, now=now + dt.timedelta(minutes=5))
    rows = raw_events.read_raw_events(spark, raw)
    assert Counter(r["event_time"] for r in rows.collect()) == {
        "2025-11-15T08:00:00+00:00": 1, "2025-11-15T12:00:00+00:00": 2}
    assert {(r["Year"], r["Month"], r["Day"]) for r in rows.collect()} == {(2025, 11, 15)}


def test_overlapping_snapshots_of_one_run_count_once(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", snapshot(MORNING, NOON))
    land(landing, "b.json", snapshot(MORNING, NOON))
    land(landing, "c.json", snapshot(MORNING)[:-3])
    raw, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    docs = snapshots.read_snapshots(spark, str(landing))
    report = ingest.run_ingest(docs, tables(spark), raw, str(tmp_path / "cutoff"), quarantine=bad)
    assert report.events["departures"] == 2 and report.snapshots["rejected"] == 1
    assert raw_events.read_raw_events(spark, raw).count() == 2
    kept = spark.read.json(bad).collect()
    assert [r["violations"] for r in kept] == [1] and kept[0]["source"].endswith("c.json")


def test_old_files_are_not_read_again(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", snapshot(MORNING))
    now = dt.datetime.now(dt.timezone.utc)
    assert snapshots.read_snapshots(spark, str(landing), landed_after=now - dt.timedelta(hours=1)).count() == 1
    assert snapshots.read_snapshots(spark, str(landing), landed_after=now + dt.timedelta(hours=1)).count() == 0


def test_a_date_far_ahead_loses_no_later_event(spark, tmp_path):
    landing = tmp_path / "landing"

    def run():
        docs = snapshots.stream_snapshots(spark, str(landing), max_files_per_trigger=1)
        found = ingest_stream.first_reports(ingest_stream.event_stream(docs, tables(spark)))
        ingest_stream.write_event_stream(
            found, str(tmp_path / "events"), str(tmp_path / "check"), once=True).awaitTermination()
        return spark.read.parquet(str(tmp_path / "events")).count()

    land(landing, "a.json", snapshot(LATER))
    assert run() == 1
    land(landing, "b.json", snapshot(MORNING, NOON))
    assert run() == 3


def test_a_batch_of_many_days_is_written_by_many_tasks(spark, tmp_path):
    days = [f"2025-11-{day:02d}T08:{minute:02d}:00Z" for day in range(1, 25) for minute in range(8)]
    landing, events = tmp_path / "landing", tmp_path / "events"
    land(landing, "a.json", snapshot(*days))
    docs = snapshots.stream_snapshots(spark, str(landing))
    found = ingest_stream.first_reports(ingest_stream.event_stream(docs, tables(spark)))
    ingest_stream.write_event_stream(
        found, str(events), str(tmp_path / "check"), once=True).awaitTermination()
    assert spark.read.parquet(str(events)).count() == len(days)
    written = [path for path in events.rglob("part-*.parquet")]
    assert len({path.name.split("-")[1] for path in written}) > ingest_stream.FILES_PER_BATCH
    assert max(Counter(path.parent for path in written).values()) <= ingest_stream.FILES_PER_BATCH


def test_a_repeated_batch_has_its_own_cutoff(spark, tmp_path):
    path = str(tmp_path / "cutoff")
    first, second = (dt.datetime(2025, 1, day, tzinfo=dt.timezone.utc) for day in (1, 2))
    state.write_cutoff(spark, path, first, batch=0)
    state.write_cutoff(spark, path, second, batch=1, before=first)
    assert state.read_cutoff(spark, path, 1) == first
    assert state.read_cutoff(spark, path, 2) == second == state.read_cutoff(spark, path)


def test_documents_land_in_a_file_for_each_task(spark, tmp_path):
    docs = spark.range(0, 70).selectExpr("cast(id as string) as value").repartition(7)
    queries._land(docs, queries._future_document(spark, "900001"), str(tmp_path / "any"))
    assert len(list((tmp_path / "any").glob("part-*.txt"))) > 6
    queries._land(docs, queries._future_document(spark, "900001"), str(tmp_path / "few"), 2)
    assert len(list((tmp_path / "few").glob("part-*.txt"))) == 2
