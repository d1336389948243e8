import csv
import datetime as dt
import glob
import gzip
import io
import json
from collections import Counter

from pyspark.sql import functions as F

from railpulse.operators import filters, manifest
from railpulse.plans import collate, ingest, timetable_refresh
from railpulse.schemas import EVENT, EVENT_COLUMNS
from railpulse.sinks import stores
from railpulse.sources import hidden_files, raw_events, state, timetables


def event(trip, time, provider="Amtrak", direction=0, route="NE R", kind="ARR", stop="NYP"):
    return (provider, "2025-01-05", route, trip, direction, stop, None, trip, trip, kind, time,
            60, None)


LAYOUT = "provider string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), LAYOUT)


def bag(df, *columns):
    return Counter(map(tuple, df.select(*(columns or sorted(df.columns))).collect()))


def pack(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if text is not None else b"")


def as_json(trip, **changes):
    fields = dict(zip(["provider", *EVENT_COLUMNS], event(trip, "2025-01-05T10:00:00+00:00")))
    del fields["provider"]
    return {**fields, **changes}


def landed(root, hidden=False):
    day = root / "raw/VIA/Year=2025/Month=01/Day=05"
    lead = "_" if hidden else ""
    pack(day / f"{lead}10_00.json.gz", json.dumps([as_json("a"), as_json("b", scheduled_headway="x")]))
    pack(day / f"{lead}10_05.json.gz", json.dumps(as_json("c"), indent=1))
    pack(day / f"{lead}10_10.json.gz", "")
    pack(day / f"{lead}10_15.json.gz", " \n ")
    pack(day / f"{lead}10_20.json.gz", json.dumps([as_json("d")])[:-5])
    pack(day / f"{lead}10_25.json.gz", "[]")
    pack(day / f"{lead}10_30.json.gz", json.dumps([as_json("e")]) + " junk")
    (day / "notes.txt").write_text("[]")


def test_landed_files(spark, tmp_path):
    landed(tmp_path)
    docs = raw_events.read_event_documents(spark, str(tmp_path / "raw"))
    rows = raw_events.with_landed_day(raw_events.parse_event_documents(docs))
    assert {(r["trip_id"], r["scheduled_headway"], r["direction_id"]) for r in rows.collect()} == {
        ("a", 60, 0), ("b", None, 0), ("c", 60, 0)}
    assert bag(rows, "provider", "Year", "Month", "Day") == Counter({("Via", 2025, 1, 5): 3})


def test_hidden_files_need_their_own_reader(spark, tmp_path):
    landed(tmp_path, hidden=True)
    pack(tmp_path / "raw/VIA/Year=2025/Month=01/Day=05/_11_00.json.gz", None)
    root = str(tmp_path / "raw")
    plain = raw_events.read_event_documents(spark, root)
    assert raw_events.parse_event_documents(plain).count() == 0
    docs = hidden_files.read_hidden_documents(spark, root)
    rows = raw_events.with_landed_day(raw_events.parse_event_documents(docs))
    assert bag(rows, "trip_id", "provider", "Day") == Counter(
        {(t, "Via", 5): 1 for t in "abc"})


def test_raw_store_round_trip_and_rerun(spark, tmp_path):
    rows = frame(spark, event("a", "2025-01-05T10:00:00+00:00"),
                 event("b", "2025-01-05T10:00:00+00:00", "Via", None))
    moment = dt.datetime(2025, 1, 5, 10, 5)
    root = str(tmp_path / "raw")
    for _ in range(2):
        stores.write_raw_events(rows, root, moment, batch="1005")
    read = raw_events.read_raw_events(spark, root)
    assert bag(read, *rows.columns) == bag(rows, *rows.columns)
    stores.write_raw_events(rows, root, moment, batch="1010")
    assert raw_events.read_raw_events(spark, root).count() == 4
    assert glob.glob(f"{root}/provider=VIA/Year=2025/Month=01/Day=05/batch=1005/*.json.gz")


def test_raw_store_skips_broken_lines(spark, tmp_path):
    day = tmp_path / "provider=Amtrak/Year=2025/Month=01/Day=05/batch=1"
    pack(day / "a.json.gz", "\n".join([json.dumps(as_json("a")), "{broken", "",
                                       json.dumps([as_json("b"), as_json("c")])]))
    (day / "notes.txt").write_text(json.dumps(as_json("z")))
    rows = raw_events.read_raw_events(spark, str(tmp_path))
    assert bag(rows, "trip_id") == Counter({("a",): 1, ("b",): 1, ("c",): 1})


def raw_week(spark, root):
    """Events with their processing day, some in the first hours of the day."""
    rows = frame(
        spark,
        event("day", "2025-01-05T10:00:00+00:00"), event("night", "2025-01-06T02:00:00+00:00"),
        event("early", "2025-01-05T01:00:00+00:00"), event("null", "2025-01-05T12:00:00+00:00",
                                                           direction=None),
        event("via", "2025-01-05T12:00:00+00:00", "Via"),
        event("third", "2025-01-05T12:00:00+00:00", "Brightline"),
        event("bad", "2025-01-05 noon"))
    processed = F.coalesce(F.col("event_time").substr(1, 10).try_cast("date"))
    stores.write_raw_events(rows, root, processed)
    return raw_events.read_raw_events(spark, root)


def test_collation_by_service_day_and_by_same_day(spark, tmp_path):
    raw = raw_week(spark, str(tmp_path / "raw"))
    day = dt.date(2025, 1, 5)
    whole = collate.collate_range(raw, day, day)
    assert {r["trip_id"] for r in whole.collect()} == {"day", "night", "null", "via"}
    same = collate.collate_range(raw, day, day, by_service_day=False)
    assert {r["trip_id"] for r in same.collect()} == {"day", "null", "via"}
    one = collate.collate_range(raw, day, day, ["Via"])
    assert {r["trip_id"] for r in one.collect()} == {"via"}
    left = collate.collated_and_left(raw, day, day).where("left_out = 'unreadable_time'")
    assert [r["trip_id"] for r in left.collect()] == ["bad"]
    counts = collate.collation_leftovers(collate.collated_and_left(raw, day, day)).collect()
    read = raw.where("provider <> 'Brightline' and Day in (5, 6)").count()
    assert sum(r["events_count"] for r in counts) == read
    assert bag(whole.where("trip_id in ('null', 'night')"),
               "trip_id", "stop_path", "Year", "Month", "Day") == Counter({
        ("null", "NE R_None_NYP", 2025, 1, 5): 1, ("night", "NE R_0_NYP", 2025, 1, 5): 1})
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan or "PartitionFilters: [(make_date" in plan \
        or "make_date" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_collation_twice_equals_once(spark, tmp_path):
    raw = raw_week(spark, str(tmp_path / "raw"))
    root, exported = str(tmp_path / "daily"), str(tmp_path / "csv")
    first, last = dt.date(2025, 1, 4), dt.date(2025, 1, 5)
    once = bag(collate.run_collation(raw, root, first, last, csv_root=exported).summary)
    twice = bag(collate.run_collation(raw, root, first, last, csv_root=exported).summary)
    assert once == twice == Counter({
        (3, 2, "Amtrak", last): 1, (1, 1, "Amtrak", first): 1, (1, 1, "Via", last): 1})
    stored = stores.read_daily_table(spark, root)
    assert filters.service_day(stored, last, "ia").count() == 1
    sliced = filters.service_day(stored, last)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in sliced and "Day" in sliced.split("PartitionFilters: [")[1].split("]")[0]
    lines = []
    newest = max(glob.glob(f"{exported}/data/stored_version=*"))
    for path in glob.glob(f"{newest}/provider=Amtrak/stop_path=NE R_0_NYP/Year=2025/Month=1/Day=5/*.gz"):
        lines += list(csv.reader(io.StringIO(gzip.open(path, "rt").read())))
    assert lines[0] == list(EVENT_COLUMNS)
    assert sorted(r[2] for r in lines if r[2] != "trip_id") == ["day", "night"]
    assert {r[11] for r in lines[1:]} <= {"", "scheduled_tt"}
    assert glob.glob(f"{newest}/provider=VIA/*")


def test_a_rerun_replaces_days_whole(spark, tmp_path):
    raw = raw_week(spark, str(tmp_path / "raw"))
    root, exported = str(tmp_path / "daily"), str(tmp_path / "csv")
    day = dt.date(2025, 1, 5)

    def trips(**options):
        collate.run_collation(options.pop("rows", raw), root, day, csv_root=exported, **options)
        table, files = stores.read_daily_table(spark, root), stores.read_daily_csv(spark, exported)
        found = [sorted(r["trip_id"] for r in t.collect()) for t in (table, files)]
        assert found[0] == found[1]
        return found[0]

    assert trips() == ["day", "night", "null", "via"]
    assert trips(by_service_day=False) == ["day", "null", "via"]
    assert trips(rows=raw.where("false"), providers=["Via"]) == ["day", "null"]
    assert trips(rows=raw.where("false")) == []
    assert trips() == ["day", "night", "null", "via"]


def test_broken_files_stop_no_others(spark, tmp_path):
    for hidden in (False, True):
        root = tmp_path / f"broken-{hidden}"
        root.mkdir()
        landed(root, hidden=hidden)
        day = root / "raw/VIA/Year=2025/Month=01/Day=05"
        lead = "_" if hidden else ""
        (day / f"{lead}12_00.json.gz").write_bytes(gzip.compress(b"[]" * 5000)[:-9])
        (day / f"{lead}12_05.json.gz").write_bytes(b"no gzip at all")
        read = hidden_files.read_hidden_documents if hidden else raw_events.read_event_documents
        docs = read(spark, str(root / "raw"))
        assert raw_events.parse_event_documents(docs).count() == 3
        broken = raw_events.broken_files(docs).collect()
        assert sorted(r["source"][-13:-8] for r in broken) == ["12_00", "12_05"]


def test_hidden_reader_lists_only_the_days_asked_for(spark, tmp_path):
    landed(tmp_path, hidden=True)
    root = str(tmp_path / "raw")
    day = dt.date(2025, 1, 5)
    for first, n in ((day, 3), (dt.date(2025, 1, 6), 0)):
        docs = hidden_files.read_hidden_documents(spark, root, ["VIA", "Amtrak"], first)
        assert raw_events.parse_event_documents(docs).count() == n
    reader = hidden_files.HiddenFilesReader(
        {"path": root, "providers": "VIA", "first": "2025-01-04", "last": "2025-01-05"})
    assert all("/Day=05/" in path for group in reader.partitions() for path in group.paths)


def test_a_rebuilt_timetable_keeps_what_was_loaded(spark, tmp_path):
    frame_of = lambda n: spark.createDataFrame([("x", n)], "k string, n int")
    root = str(tmp_path / "tables")
    ingest.TimetableTables(frame_of(1), frame_of(1), frame_of(1)).save(root)
    before = ingest.TimetableTables.load(spark, root)
    ingest.TimetableTables(frame_of(2), frame_of(2), frame_of(2)).save(root)
    after = ingest.TimetableTables.load(spark, root)
    for tables, n in ((before, 1), (after, 2)):
        assert [t.first()["n"] for t in (tables.means, tables.by_train_number, tables.by_last_stop)] == [n] * 3


def test_csv_quotes(spark, tmp_path):
    rows = collate.daily_events(frame(
        spark, event('say "hi", ok', "2025-01-05T10:00:00+00:00")))
    stores.write_daily_csv(rows, str(tmp_path / "csv"), rows)
    path = glob.glob(f"{tmp_path}/csv/**/*.csv.gz", recursive=True)[0]
    assert '"say ""hi"", ok"' in gzip.open(path, "rt").read()


def test_small_csv_days_are_written_by_all_tasks(spark, tmp_path):
    rows = [event(f"t{n}", f"2025-01-{d:02d}T12:00:00+00:00", stop=f"S{n}") for n in range(64) for d in (5, 6)]
    daily = collate.daily_events(frame(spark, *rows)).drop("service_day")
    stores.write_daily_csv(daily, str(tmp_path), daily.select("provider", "Year", "Month", "Day").distinct())
    found = glob.glob(f"{tmp_path}/data/*/*/*/*/*/*/part-*.csv.gz")
    tasks = {}
    for path in found:
        tasks.setdefault(path.split("stop_path=")[1].split("/")[0], set()).add(path.split("/part-")[1][:5])
    assert len(found) == 128 and len(tasks) == 64
    assert all(len(own) == 1 for own in tasks.values())
    assert len(set().union(*tasks.values())) > 4


def test_cutoff_state(spark, tmp_path):
    path = str(tmp_path / "cutoff")
    assert state.read_cutoff(spark, path) is None
    for hour in (1, 2, 3):
        moment = dt.datetime(2025, 1, 5, hour, tzinfo=dt.timezone.utc)
        state.write_cutoff(spark, path, moment)
        assert state.read_cutoff(spark, path) == moment
    assert len(glob.glob(f"{path}/commit=*")) == 3
    bad = tmp_path / "bad/commit=0"
    bad.mkdir(parents=True)
    (bad / "part.json").write_text("{oops")
    assert state.read_cutoff(spark, str(tmp_path / "bad")) is None


PAIR = "agency string, last_modified string"


def test_manifest(spark):
    cached = spark.createDataFrame([("A", "x"), ("B", "y")], PAIR)
    current = spark.createDataFrame([("A", "x"), ("B", "z"), ("C", "w"), ("D", None)], PAIR)
    changed = manifest.changed_timetables(current, cached)
    assert {r["agency"] for r in changed.collect()} == {"B", "C"}
    assert bag(manifest.merged_manifest(current, cached), "agency", "last_modified") == Counter(
        {("A", "x"): 1, ("B", "z"): 1, ("C", "w"): 1})


def test_refresh_writes_only_changes(spark, tmp_path):
    path = str(tmp_path / "manifest")
    now = "Wed, 12 Nov 2025 10:00:00 GMT"
    headers = spark.createDataFrame([("A", now), ("B", None)], PAIR)
    assert timetable_refresh.run_refresh(headers, path) == ["A"]
    assert timetable_refresh.run_refresh(headers, path) == []
    assert bag(state.read_manifest(spark, path)) == Counter({("A", "2025-11-12T10:00:00"): 1})
    later = spark.createDataFrame([("A", None), ("B", now)], PAIR)
    assert timetable_refresh.run_refresh(later, path) == ["B"]
    assert state.read_manifest(spark, path).count() == 2


def test_bundles(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    for folder in (one, two):
        folder.mkdir()
    (one / "trips.txt").write_text(
        "﻿route_id,service_id,trip_id,trip_short_name,direction_id\n"
        "R,1,007,10,0\nR,1,8,10,1\nR,1,9,,\n")
    (one / "stop_times.txt").write_text(
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence,pickup_type\n"
        "007,06:05:00,06:06:00,01,1,0\n007,25:00:00,25:01:00,02,2,0\n")
    (two / "trips.txt").write_text("trip_id,route_id\n1,Q\n")
    (two / "stop_times.txt").write_text(
        "stop_id,trip_id,stop_sequence,departure_time,arrival_time\nX,1,1,07:00:00,07:00:00\n")
    times, trips = timetables.read_bundles(spark, {"Amtrak": str(one), "Brightline": str(two)})
    assert bag(trips, "provider", "trip_id", "route_id", "trip_short_name", "direction_id") == (
        Counter({("Amtrak", "007", "R", "10", 0): 1, ("Amtrak", "8", "R", "10", 1): 1,
                 ("Amtrak", "9", "R", None, None): 1, ("Brightline", "1", "Q", None, None): 1}))
    assert bag(times, "provider", "trip_id", "stop_id", "arrival_time", "stop_sequence") == (
        Counter({("Amtrak", "007", "01", "06:05:00", 1): 1,
                 ("Amtrak", "007", "02", "25:00:00", 2): 1,
                 ("Brightline", "1", "X", "07:00:00", 1): 1}))
    from railpulse.operators.timetable import direction_by_train_number
    first = direction_by_train_number(trips, ["provider"])
    assert ("Amtrak", "10", 0) in bag(first, "provider", "trip_short_name", "direction_id")


def test_stored_table_keeps_row_order(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame([("k", None), ("k", 1)], "trip_short_name string, direction_id int"
                          ).coalesce(1).write.parquet(path)
    from railpulse.operators.timetable import direction_by_train_number
    trips = timetables.read_table(spark, path)
    assert bag(direction_by_train_number(trips), "trip_short_name", "direction_id") == Counter(
        {("k", None): 1})


def test_a_day_without_events_leaves_other_days(spark, tmp_path):
    raw = raw_week(spark, str(tmp_path / "raw"))
    root = str(tmp_path / "daily")
    empty = collate.run_collation(raw, root, dt.date(2024, 1, 1))
    assert empty.summary.count() == 0
    assert bag(empty.missing, "provider") == Counter({("Amtrak",): 1, ("Via",): 1})
    collate.run_collation(raw, root, dt.date(2025, 1, 5))
    collate.run_collation(raw, root, dt.date(2024, 1, 1))
    assert stores.read_daily_table(spark, root).count() == 4


def test_saving_timetable_tables_reads_the_stop_times_once(spark, tmp_path):
    rows = [(f"t{n % 9}", f"0{n % 10}:00:00", f"0{n % 10}:00:00", f"s{n % 5}", n) for n in range(90)]
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    stop_times = spark.createDataFrame(
        spark.sparkContext.parallelize(rows, 2).map(counted),
        "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence bigint")
    trips = spark.createDataFrame([(f"t{n}", "r", n % 2, str(n), n) for n in range(9)],
                                  "trip_id string, route_id string, direction_id int, trip_short_name string, ord int")
    ingest.TimetableTables.build(stop_times, trips).save(str(tmp_path))
    assert read.value == len(rows)
    found = ingest.TimetableTables.load(spark, str(tmp_path))
    assert found.by_train_number.count() == 9 and found.means.count() == 10 and found.by_last_stop.count() > 0
