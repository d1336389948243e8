"""One query per operator, over the whole given tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.checks import views
from railpulse.functions import timecols
from railpulse.functions.once import evaluated_once
from railpulse.operators import enrich, events, filters, manifest, quality, reshape, sequence, service_days, timetable
from railpulse.plans import collate, ingest, timetable_refresh
from railpulse.schemas import BRIGHTLINE, EVENT_COLUMNS, PROVIDERS
from railpulse.session import shared_folder
from railpulse.sinks import compaction, stores
from railpulse.sources import raw_events, snapshots, timetables
from railpulse.streaming import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
CUTOFF = "2024-01-15 00:00:00"
FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
ONE_DAY = dt.date(2024, 1, 15)
EMPTY_DAYS = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
STOP_KEY = ("trip_id", "stop_sequence", "stop_id")
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and times as text, so that comparisons do not depend on their type."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _stops(spark: SparkSession, sf: str, positions: bool = False) -> DataFrame:
    return timetable.scheduled_stops(
        views.stop_times(spark, sf, positions), views.trips(spark, sf))


def _directed(spark: SparkSession, sf: str) -> DataFrame:
    trips = views.trips(spark, sf)
    return enrich.with_direction(
        views.station_rows(spark, sf),
        timetable.direction_by_train_number(trips),
        timetable.direction_by_last_stop(trips, views.stop_times(spark, sf)))


def _with_metrics(spark: SparkSession, sf: str) -> DataFrame:
    means = timetable.scheduled_metric_means(views.stop_times(spark, sf), views.trips(spark, sf))
    return enrich.with_scheduled_metrics(_directed(spark, sf), means)


# --- timetable -----------------------------------------------------------------------

@query
def gtfs_time_seconds(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("arrival_time")
    return views.stop_times(spark, sf).select(
        *STOP_KEY, "arrival_time",
        timecols.clock_seconds(text).alias("seconds"),
        timecols.clock_seconds(text, extended_hours=True).alias("extended_seconds"))


def _bundles(spark: SparkSession, sf: str) -> dict[str, str]:
    """Two providers' timetables as published: CSV text with a byte order mark, quotes and commas
    in cells, columns in another order for each, and some that nothing here reads."""
    root = shared_folder(spark, "bundles")
    stop_times, trips = views.stop_times(spark, sf), views.trips(spark, sf).drop("ord")
    number = F.regexp_replace("trip_id", "^P", "").cast("long")
    sign = F.concat(F.lit('To "Main", track '), F.col("trip_id"))
    found = {}
    for odd, provider in enumerate((PROVIDERS[0], PROVIDERS[1])):
        found[provider] = f"{root}/{provider}"
        for rows, name, text in ((stop_times, "stop_times", "stop_headsign"), (trips, "trips", "trip_headsign")):
            own = rows.where(number % 2 == odd).withColumn(text, sign)
            columns = sorted(own.columns, reverse=bool(odd))
            marked = own.select(*columns).withColumnRenamed(columns[0], "\ufeff" + columns[0])
            marked.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(
                f"{found[provider]}/{name}.txt")
    return found


@query
def gtfs_csv_bundles(spark: SparkSession, sf: str) -> DataFrame:
    """Timetables of two providers read from CSV text and loaded in one frame."""
    stop_times, trips = timetables.read_bundles(spark, _bundles(spark, sf))
    return timetable.scheduled_stops(stop_times, trips, ["provider"]).select(
        "provider", *STOP_KEY, "route_id", "direction_id", "arrival_time", "departure_time")


@query
def gtfs_stop_times(spark: SparkSession, sf: str) -> DataFrame:
    return _stops(spark, sf).select(
        *STOP_KEY, "route_id", "direction_id", "arrival_time", "departure_time")


@query
def scheduled_headway(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.with_scheduled_headway(_stops(spark, sf, positions=True)).select(
        *STOP_KEY, "route_id", "direction_id", "arrival_time", "scheduled_headway")


@query
def scheduled_travel_time(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.with_scheduled_travel_time(_stops(spark, sf)).select(
        *STOP_KEY, "arrival_time", "scheduled_tt")


@query
def gtfs_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = timetable.timetable_metrics(
        views.stop_times(spark, sf, positions=True), views.trips(spark, sf))
    return rows.select(
        *STOP_KEY, "route_id", "direction_id", "arrival_time", "scheduled_headway", "scheduled_tt")


@query
def scheduled_metric_means(spark: SparkSession, sf: str) -> DataFrame:
    means = timetable.scheduled_metric_means(views.stop_times(spark, sf), views.trips(spark, sf))
    return means.withColumns({
        c: F.round(c, 6) for c in ("scheduled_headway", "scheduled_tt")})


@query
def last_stop_per_trip(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.last_stop_per_trip(views.stop_times(spark, sf))


@query
def direction_lookup_primary(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.direction_by_train_number(views.trips(spark, sf))


@query
def direction_lookup_secondary(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.direction_by_last_stop(views.trips(spark, sf), views.stop_times(spark, sf))


@query
def scheduled_headway_by_day(spark: SparkSession, sf: str) -> DataFrame:
    days = service_days.active_days(*views.service_calendar(spark, sf))
    services = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("trip_id"), (F.col("o_custkey") % 5).alias("service_id"))
    stops = timetable.join_on(_stops(spark, sf, positions=True), services, ["trip_id"], hot=False)
    found = service_days.with_headway_by_day_type(stops, days)
    return _text(found.select(*STOP_KEY, "service_id", "day_type", "scheduled_headway"), "day_type")


@query
def service_day_types(spark: SparkSession, sf: str) -> DataFrame:
    days = service_days.active_days(*views.service_calendar(spark, sf))
    return _text(service_days.day_types(days), "service_day", "day_type")


@query
def stop_sequence_fill(spark: SparkSession, sf: str) -> DataFrame:
    numbers = views.trips(spark, sf).select("trip_id", F.col("trip_short_name").alias("trainNumRaw"))
    planned = timetable.with_clock_times(views.stop_times(spark, sf), extended_hours=True)
    calls = timetable.join_on(planned, numbers, ["trip_id"], hot=False).withColumnRenamed("stop_id", "code")
    seen = F.coalesce("arr", "dep")
    rows = views.station_rows(spark, sf).withColumn(
        "second", (F.hour(seen) * 3600 + F.minute(seen) * 60 + F.second(seen)).cast("int"))
    return sequence.with_stop_sequence(rows, calls, ["trainNumRaw", "code"], "second").select(
        "event_id", "trainNumRaw", "code", "stop_sequence", "planned_time", "off_plan")


# --- enrichment ----------------------------------------------------------------------

@query
def direction_id(spark: SparkSession, sf: str) -> DataFrame:
    return _directed(spark, sf).select(
        "event_id", "trainNumRaw", "destCode", "direction_id", "lookup_method")


@query
def direction_match_stats(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.direction_match_stats(_directed(spark, sf))


@query
def direction_custom_headsign(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.station_rows(spark, sf)
    return enrich.with_headsign_direction(rows, views.HEADSIGNS).select(
        "event_id", "destCode", "direction_id")


@query
def scheduled_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _with_metrics(spark, sf).select(
        "event_id", "code", "direction_id", "scheduled_headway", "scheduled_tt")


@query
def metric_match_stats(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.metric_match_stats(_with_metrics(spark, sf))


# --- time expressions ----------------------------------------------------------------

@query
def service_dates(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.add_service_dates(views.station_rows(spark, sf)).select(
        "event_id", "service_date_arr", "service_date_dep")


@query
def service_date_eastern(spark: SparkSession, sf: str) -> DataFrame:
    day = timecols.service_date(F.col("dep"), zone=timecols.EASTERN)
    return views.station_rows(spark, sf).select("event_id", day.cast("string").alias("service_date"))


@query
def parse_iso_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Four spellings of the same moment, the last one not accepted."""
    moment = timecols.whole_second(F.col("ts"))
    utc = F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))
    local = F.replace((moment - F.make_dt_interval(hours=F.lit(5))).cast("string"),
                      F.lit(" "), F.lit("T"))
    spelled = (
        F.when(F.col("event_id") % 4 == 0, F.concat(utc, F.lit("Z")))
        .when(F.col("event_id") % 4 == 1, F.concat(local, F.lit("-05:00")))
        .when(F.col("event_id") % 4 == 2, F.concat(local, F.lit("-0500")))
        .otherwise(F.concat(utc, F.lit(".000Z"))))
    return views.table(spark, sf, "events").select(
        "event_id", timecols.parse_iso(spelled).cast("string").alias("parsed"))


@query
def parse_http_date(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return views.table(spark, sf, "events").select(
        "event_id", timecols.parse_http_date(text).cast("string").alias("parsed"))


# --- reading snapshots ---------------------------------------------------------------

@query
def flatten_map_rows(spark: SparkSession, sf: str) -> DataFrame:
    parsed = snapshots.parse_snapshots(views.documents(spark, sf))
    trains = reshape.flatten_trains(snapshots.accepted_snapshots(parsed))
    return reshape.keep_train_columns(trains).select(
        "routeName", "trainNumRaw", "destCode", "provider", F.size("stations").alias("stops"))


@query
def snapshot_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Documents spoiled in several ways, and the number of faults found in each."""
    checked = snapshots.parse_snapshots(views.spoiled_documents(spark, sf))
    return checked.select("document_id", "violations")


@query
def snapshot_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.snapshot_counts(snapshots.parse_snapshots(views.spoiled_documents(spark, sf)))


@query
def snapshot_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected documents written to quarantine and read back."""
    root = shared_folder(spark, "quarantine")
    rejected = snapshots.rejected_snapshots(snapshots.parse_snapshots(views.spoiled_documents(spark, sf)))
    stores.write_quarantine(rejected, root, "run")
    kept = spark.read.schema("document_id bigint, value string, violations int").json(root)
    return kept.where("value is not null").select("document_id", "violations")


@query
def explode_stations(spark: SparkSession, sf: str) -> DataFrame:
    parsed = snapshots.parse_snapshots(views.documents(spark, sf))
    rows = reshape.station_rows(snapshots.accepted_snapshots(parsed))
    return _text(rows, "arr", "dep", "schArr", "schDep")


@query
def snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    return _text(ingest.read_stage(views.documents(spark, sf), CUTOFF),
                 "arr", "dep", "schArr", "schDep")


@query
def incremental_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.newer_than(views.station_rows(spark, sf), CUTOFF)
    return _text(rows.select("event_id", "dep"), "dep")


@query
def incremental_filter_first_run(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.newer_than(views.station_rows(spark, sf), None)
    return _text(rows.select("event_id", "dep"), "dep")


@query
def departed_rail_only(spark: SparkSession, sf: str) -> DataFrame:
    return filters.departed_rail(views.station_rows(spark, sf)).select(
        "event_id", "bus", "status")


@query
def provider_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.known_providers(views.station_rows(spark, sf))
    return filters.enabled_providers(rows).select("event_id", "provider")


@query
def ingest_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return quality.ingest_funnel(views.station_rows(spark, sf), CUTOFF)


@query
def preview_service_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = reshape.add_service_dates(views.station_rows(spark, sf))
    return _text(reshape.preview(rows), "arr", "dep")


# --- events --------------------------------------------------------------------------

@query
def arr_dep_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.departed_rail(_with_metrics(spark, sf))
    return events.arr_dep_events(rows)


@query
def event_generation(spark: SparkSession, sf: str) -> DataFrame:
    return views.generated_events(spark, sf)


@query
def event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return events.event_counts(views.generated_events(spark, sf))


@query
def event_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping runs: the second reports departures again, with other metrics."""
    first = views.generated_events(spark, sf)
    runs = F.when(F.col("event_type") == "DEP", F.array(F.lit(2), F.lit(1))).otherwise(
        F.array(F.lit(1)))
    repeated = first.withColumn("run", F.explode(runs)).withColumns({
        "landed_at": F.make_date(F.lit(2024), F.lit(1), F.col("run")),
        "scheduled_tt": F.col("scheduled_tt") + F.col("run") - 1})
    return events.dedupe_events(repeated).select("provider", *EVENT_COLUMNS)


FILES_PER_BATCH = 4


def _future_document(spark: SparkSession, train: str) -> DataFrame:
    """A snapshot whose one departure lies far ahead, as a broken clock would report it."""
    known = json.loads(views.FUTURE_DOCUMENT)
    known = {train: [{**known[0], "trainNumRaw": train}]}
    return spark.createDataFrame([(json.dumps(known),)], "value string")


def _land(docs: DataFrame, future: DataFrame, landing: str, files: int | None = None) -> None:
    """Add files for one micro-batch: so many, or one for each task that makes documents."""
    rows = docs.select("value").unionAll(future)
    (rows.repartition(files) if files else rows).write.mode("append").text(landing)


def _saved_tables(spark: SparkSession, sf: str, root: str) -> ingest.TimetableTables:
    views.timetable_tables(spark, sf).save(f"{root}/timetable")
    return ingest.TimetableTables.load(spark, f"{root}/timetable")


@query
def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots landed as files, streamed to a deduplicated event store, read back.

    The first of two micro-batches reports a departure far in the future; the second has
    the other half of the documents, and some of the first again.
    """
    root = shared_folder(spark, "stream")
    docs = views.documents(spark, sf)
    odd = F.col("document_id") % 2 == 1
    _land(docs.where(~odd), _future_document(spark, "900001"), f"{root}/landing", FILES_PER_BATCH)
    _land(docs.where(odd | (F.col("document_id") % 10 == 0)), _future_document(spark, "900001"),
          f"{root}/landing", FILES_PER_BATCH)
    landed = snapshots.stream_snapshots(
        spark, f"{root}/landing", one_per_line=True, max_files_per_trigger=FILES_PER_BATCH)
    found = ingest_stream.first_reports(
        ingest_stream.event_stream(landed, _saved_tables(spark, sf, root)))
    ingest_stream.write_event_stream(
        found, f"{root}/events", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/events").select("provider", *EVENT_COLUMNS)


@query
def cutoff_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Cutoff ingest whose first batch runs again, as after a crash before its commit.

    The second batch then has nothing new but a departure past the cutoff.
    """
    root = shared_folder(spark, "cutoff")
    docs = views.documents(spark, sf)
    odd = F.col("document_id") % 2 == 1
    tables = _saved_tables(spark, sf, root)

    def run() -> None:
        landed = snapshots.stream_snapshots(spark, f"{root}/landing", one_per_line=True)
        ingest_stream.start_cutoff_ingest(
            landed, tables, f"{root}/raw", f"{root}/state", f"{root}/checkpoint",
            once=True).awaitTermination()

    _land(docs.where(~odd), _future_document(spark, "900001"), f"{root}/landing")
    run()
    store, checkpoint = fs.FileSystem.from_uri(f"{root}/checkpoint")
    for name in ("0", ".0.crc"):
        place = f"{checkpoint}/commits/{name}"
        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_file(place)
    run()
    _land(docs.where(odd), _future_document(spark, "900002"), f"{root}/landing")
    run()
    return raw_events.read_raw_events(spark, f"{root}/raw").select("provider", *EVENT_COLUMNS)


@query
def ingest_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two batch runs over overlapping snapshots, with the timetable rebuilt in between."""
    root = shared_folder(spark, "runs")
    # Stored as landed: both runs read what is there, and none makes the documents anew.
    views.documents(spark, sf).write.parquet(f"{root}/landing")
    docs = spark.read.parquet(f"{root}/landing")
    landed = [docs.withColumn("landed_at", F.lit(f"2024-01-14 0{hour}:00:00").cast("timestamp_ntz"))
              for hour in (1, 2)]
    even = F.col("document_id") % 2 == 0
    first = landed[0].where(even).unionAll(landed[1].where(even))
    tables = _saved_tables(spark, sf, root)
    moment = dt.datetime.fromisoformat(f"{CUTOFF}+00:00")
    ingest.run_ingest(first, tables, f"{root}/raw", f"{root}/state", now=moment)
    _saved_tables(spark, sf, root)  # the tables loaded before stay readable
    ingest.run_ingest(landed[0].unionAll(landed[1]), tables, f"{root}/raw", f"{root}/state",
                      now=moment + dt.timedelta(days=1))
    return raw_events.read_raw_events(spark, f"{root}/raw").select("provider", *EVENT_COLUMNS)


# --- raw store and collation ---------------------------------------------------------

@query
def raw_events_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Files as arrays and as single objects, with broken and blank ones in between."""
    rows = evaluated_once(views.raw_events(spark, sf), text=F.to_json(F.struct(*EVENT_COLUMNS)))
    text = F.col("text")
    document = (
        F.when(F.col("event_type") == "ARR", F.concat(F.lit("["), text, F.lit(",\n "), text, F.lit("]")))
        .otherwise(F.concat(F.lit("\n"), text, F.lit(" \n"))))
    broken = F.array(document, F.concat(F.lit("["), text), F.lit(" \n"), F.concat(text, F.lit(" x")),
                     F.lit("[]"))
    docs = rows.select("provider", F.explode(broken).alias("value"))
    return raw_events.parse_event_documents(docs)


@query
def raw_event_store(spark: SparkSession, sf: str) -> DataFrame:
    """Events written to the raw store and read back."""
    root = shared_folder(spark, "raw")
    rows = views.raw_events(spark, sf)
    stores.write_raw_events(rows, root, F.make_date("Year", "Month", "Day"))
    return raw_events.read_raw_events(spark, root).select(
        "provider", "Year", "Month", "Day", *EVENT_COLUMNS)


def _month(spark: SparkSession, sf: str, by_service_day: bool = True) -> DataFrame:
    return collate.collate_range(
        views.raw_events(spark, sf), FIRST_DAY, LAST_DAY, PROVIDERS, by_service_day)


@query
def daily_events(spark: SparkSession, sf: str) -> DataFrame:
    return collate.daily_events(views.raw_events(spark, sf)).drop("service_day")


@query
def collate_range(spark: SparkSession, sf: str) -> DataFrame:
    return _month(spark, sf).drop("service_day")


@query
def collate_same_day(spark: SparkSession, sf: str) -> DataFrame:
    return _month(spark, sf, by_service_day=False).drop("service_day")


@query
def service_day_slice(spark: SparkSession, sf: str) -> DataFrame:
    """One day of the stored table; only its folders are read."""
    root = shared_folder(spark, "slice")
    collate.run_collation(views.raw_events(spark, sf), root, FIRST_DAY, LAST_DAY, PROVIDERS)
    return filters.service_day(stores.read_daily_table(spark, root), ONE_DAY)


@query
def collation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _text(collate.collation_summary(_month(spark, sf)), "service_day")


def _raw_store(spark: SparkSession, sf: str, root: str) -> DataFrame:
    stores.write_raw_events(views.raw_events(spark, sf), f"{root}/raw", F.make_date("Year", "Month", "Day"))
    return raw_events.read_raw_events(spark, f"{root}/raw")


@query
def raw_store_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """A month collated from a compacted raw store, to which a batch was added since, and of which
    another ran again for some days."""
    root = shared_folder(spark, "compacted")
    raw, store = f"{root}/raw", f"{root}/days"
    even, day, moment = F.col("trip_id").cast("int") % 2 == 0, F.col("Day"), F.make_date("Year", "Month", "Day")
    # In folders by what the batches share, so that each reads its own rows and no others.
    early, odd = F.when(day <= 5, F.lit(0)).otherwise(F.lit(1)), F.when(day < 20, F.lit(2)).when(day >= 20, F.lit(3))
    views.raw_events(spark, sf).withColumn("part", F.when(even, early).when(~even, odd)).write.partitionBy(
        "part").parquet(f"{root}/events")
    rows, part = spark.read.parquet(f"{root}/events"), F.col("part")
    until = LAST_DAY + dt.timedelta(days=1)

    def land(batches: dict[int, Column]) -> None:
        """Batches of different names, side by side as two ingests would write them."""
        def write(batch: int) -> None:
            stores.write_raw_events(rows.where(batches[batch]), raw, moment, batch)

        with ThreadPoolExecutor(len(batches)) as pool:
            list(pool.map(inheritable_thread_target(write), batches))

    land({0: (part <= 1) & ((day > 5) | (F.col("event_type") == "ARR")), 1: part == 2})
    compaction.compact_raw_days(spark, raw, store, FIRST_DAY, until, PROVIDERS)
    land({0: part == 0, 2: part == 3})
    # Of the day after the last only the first hours belong to the month.
    found = compaction.read_raw_days(spark, raw, store, FIRST_DAY, until, PROVIDERS,
                                     before=dt.datetime.combine(until, dt.time(3)))
    return collate.collate_range(found, FIRST_DAY, LAST_DAY, PROVIDERS).drop("service_day")


@query
def daily_store(spark: SparkSession, sf: str) -> DataFrame:
    """A month collated by service day, again by calendar day, and some days without events:
    the rows of the daily table after these runs, each of which replaces its days whole."""
    root = shared_folder(spark, "daily")
    raw, table = _raw_store(spark, sf, root), f"{root}/table"
    collate.run_collation(raw, table, FIRST_DAY, LAST_DAY, PROVIDERS)
    collate.run_collation(raw, table, FIRST_DAY, LAST_DAY, PROVIDERS, by_service_day=False)
    collate.run_collation(raw.where(F.lit(False)), table, *EMPTY_DAYS, PROVIDERS)
    return stores.read_daily_table(spark, table)


@query
def daily_store_concurrent(spark: SparkSession, sf: str) -> DataFrame:
    """A month collated by one run per provider, side by side over one store: the rows of the
    table then. A provider that can't be read is reported, and the others' days are there."""
    root = shared_folder(spark, "concurrent")
    raw = _raw_store(spark, sf, root)

    def read_raw(provider: str) -> DataFrame:
        if provider == BRIGHTLINE:
            return raw_events.read_raw_events(spark, f"{root}/absent")
        return raw

    found = collate.run_collation_apart(read_raw, f"{root}/table", FIRST_DAY, LAST_DAY, PROVIDERS)
    stopped = {provider for provider, outcome in found.items() if outcome.error}
    if stopped != {BRIGHTLINE}:
        raise RuntimeError(f"stopped: {found}")
    return stores.read_daily_table(spark, f"{root}/table")


@query
def collation_report(spark: SparkSession, sf: str) -> DataFrame:
    """What a run of a month says of itself after its one pass: counts by reason, missing days."""
    root = shared_folder(spark, "report")
    raw = _raw_store(spark, sf, root).where("Day <> 7")
    report = collate.run_collation(raw, f"{root}/table", FIRST_DAY, LAST_DAY, PROVIDERS)
    counts = report.leftovers.select("provider", F.coalesce("left_out", F.lit("kept")).alias("kind"),
                                     F.col("service_day").alias("day"), "events_count")
    missing = report.missing.select("provider", F.lit("missing").alias("kind"), "day",
                                    F.lit(0).cast("long").alias("events_count"))
    return _text(counts.unionAll(missing), "day")


@query
def daily_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the CSV files of a month collated by calendar day, of which some days are
    replaced by nothing."""
    root = shared_folder(spark, "csv")
    raw, table, csv = _raw_store(spark, sf, root), f"{root}/table", f"{root}/csv"
    collate.run_collation(raw, table, FIRST_DAY, LAST_DAY, PROVIDERS, False, csv)
    collate.run_collation(raw.where(F.lit(False)), table, *EMPTY_DAYS, PROVIDERS, csv_root=csv)
    return stores.read_daily_csv(spark, csv)


@query
def collation_leftovers(spark: SparkSession, sf: str) -> DataFrame:
    """What a month's run reads, kept or left out with the reason; some times are unreadable."""
    spoiled = F.when(F.col("trip_id").cast("int") % 97 == 0, F.lit("unknown")).otherwise(F.col("event_time"))
    raw = views.raw_events(spark, sf).withColumn("event_time", spoiled)
    return _text(collate.collation_leftovers(
        collate.collated_and_left(raw, FIRST_DAY, LAST_DAY, PROVIDERS)), "service_day")


@query
def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    """Each user as a provider of its own: the days of its span without an event."""
    observed = views.table(spark, sf, "events").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("provider"),
        F.col("ts").cast("date").alias("day"))
    span = observed.groupBy("provider").agg(F.sequence(F.min("day"), F.max("day")).alias("days"))
    expected = span.select("provider", F.explode("days").alias("day"))
    return _text(quality.missing_days(expected, observed), "day")


# --- timetable refresh ---------------------------------------------------------------

@query
def manifest_diff(spark: SparkSession, sf: str) -> DataFrame:
    headers, cached = views.manifests(spark, sf)
    return manifest.changed_timetables(timetable_refresh.dates_from_headers(headers), cached)


@query
def manifest_merge(spark: SparkSession, sf: str) -> DataFrame:
    headers, cached = views.manifests(spark, sf)
    return manifest.merged_manifest(timetable_refresh.dates_from_headers(headers), cached)
