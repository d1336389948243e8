"""Command-line entry for spark-submit: ``timetable``, ``ingest``, ``stream``, ``collate``, ``refresh``.

The session comes from the cluster. Times and schedules belong to whatever starts the
jobs; a backfill is ``collate`` with a first and a last day.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from railpulse.plans import collate, ingest, timetable_refresh
from railpulse.schemas import DEFAULT_ENABLED, MANIFEST, PROVIDER_PATH_NAMES, provider_named
from railpulse.sources import hidden_files, raw_events, snapshots, state, timetables
from railpulse.streaming import ingest_stream

FEED = ("provider",)
LISTING_GRACE = dt.timedelta(hours=1)


def _pairs(texts: list[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def run_timetable(spark: SparkSession, args: argparse.Namespace) -> str:
    stop_times, trips = timetables.read_bundles(spark, _pairs(args.bundle))
    ingest.TimetableTables.build(stop_times, trips, FEED).save(args.tables)
    return args.tables


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> str:
    tables = ingest.TimetableTables.load(spark, args.tables, FEED)
    # Files that landed well before the last run were read by it.
    cutoff = state.read_cutoff(spark, args.state)
    since = cutoff - LISTING_GRACE if cutoff else None
    docs = snapshots.read_snapshots(spark, args.landing, args.one_per_line, since)
    report = ingest.run_ingest(
        docs, tables, args.raw, args.state, args.provider, quarantine=args.quarantine)
    return json.dumps({**asdict(report), "cutoff": report.cutoff.isoformat()})


def run_stream(spark: SparkSession, args: argparse.Namespace) -> str:
    docs = snapshots.stream_snapshots(spark, args.landing, args.one_per_line)

    def tables() -> ingest.TimetableTables:
        return ingest.TimetableTables.load(spark, args.tables, FEED)

    if args.dedupe:
        events = ingest_stream.first_reports(ingest_stream.event_stream(docs, tables(), args.provider))
        query = ingest_stream.write_event_stream(events, args.raw, args.checkpoint, args.once)
    else:
        query = ingest_stream.start_cutoff_ingest(
            docs, tables, args.raw, args.state, args.checkpoint, args.provider, args.once,
            quarantine=args.quarantine)
    query.awaitTermination()
    return json.dumps({"batches": (query.lastProgress or {}).get("batchId", -1) + 1})


def _raw(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame | None]:
    """Raw events in the layout named, and their documents where files can be broken."""
    if args.layout == "own":
        return raw_events.read_raw_events(spark, args.raw), None
    if args.layout == "stream":
        return spark.read.parquet(args.raw), None
    if args.layout == "hidden":
        first = args.first or collate.yesterday()
        last = (args.last or first) + dt.timedelta(days=args.late_days)
        spelled = [PROVIDER_PATH_NAMES[p] for p in args.provider]
        docs = hidden_files.read_hidden_documents(spark, args.raw, spelled, first, last)
    else:
        docs = raw_events.read_event_documents(spark, args.raw)
    return raw_events.parse_event_documents(raw_events.with_landed_day(docs)), docs


def run_collate(spark: SparkSession, args: argparse.Namespace) -> str:
    raw, docs = _raw(spark, args)
    report = collate.run_collation(
        raw, args.table, args.first, args.last, args.provider, not args.same_day, args.csv,
        args.late_days)
    totals = report.summary.groupBy().sum("events_count", "files_uploaded").first()
    # A row per provider, reason and day, and per missing day or broken file.
    left = [row.asDict() for row in report.leftovers.orderBy("provider", "left_out", "service_day").collect()]
    for row in left:
        row["service_day"] = row["service_day"] and row["service_day"].isoformat()
    missing = [[r["provider"], r["day"].isoformat()] for r in report.missing.orderBy("provider", "day").collect()]
    broken = [] if docs is None else [list(r) for r in raw_events.broken_files(docs).collect()]
    return json.dumps({
        "events_count": totals[0] or 0, "files_uploaded": totals[1] or 0,
        "events_read": sum(row["events_count"] for row in left),
        "left_out": [row for row in left if row["left_out"]], "missing_days": missing,
        "broken_files": broken})


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> str:
    headers = spark.read.schema(MANIFEST).json(args.headers)
    return json.dumps(timetable_refresh.run_refresh(headers, args.manifest))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="railpulse")
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("timetable", help="build the lookup and metric tables")
    job.add_argument("--bundle", action="append", required=True, help="provider=folder")
    job.add_argument("--tables", required=True)
    job.set_defaults(run=run_timetable)

    job = jobs.add_parser("ingest", help="snapshots -> raw events")
    for name in ("landing", "tables", "raw", "state"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--one-per-line", action="store_true")
    job.add_argument("--provider", nargs="+", type=provider_named, default=list(DEFAULT_ENABLED))
    job.add_argument("--quarantine", help="folder for rejected documents")
    job.set_defaults(run=run_ingest)

    job = jobs.add_parser("stream", help="snapshots -> raw events, as they land")
    for name in ("landing", "tables", "raw", "checkpoint"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--state", help="cutoff state, needed without --dedupe")
    job.add_argument("--dedupe", action="store_true", help="keep late departures, drop repeated reports")
    job.add_argument("--one-per-line", action="store_true")
    job.add_argument("--once", action="store_true", help="stop when all that has landed is read")
    job.add_argument("--provider", nargs="+", type=provider_named, default=list(DEFAULT_ENABLED))
    job.add_argument("--quarantine", help="folder for rejected documents")
    job.set_defaults(run=run_stream)

    job = jobs.add_parser("collate", help="raw events -> daily events")
    job.add_argument("--raw", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--csv")
    job.add_argument("--first", type=dt.date.fromisoformat)
    job.add_argument("--last", type=dt.date.fromisoformat)
    job.add_argument("--provider", nargs="+", type=provider_named, default=list(DEFAULT_ENABLED))
    job.add_argument("--layout", choices=("own", "stream", "landed", "hidden"), default="own")
    job.add_argument("--late-days", type=int, default=1, help="raw days read after the last day")
    job.add_argument("--same-day", action="store_true")
    job.set_defaults(run=run_collate)

    job = jobs.add_parser("refresh", help="which timetables changed")
    job.add_argument("--headers", required=True)
    job.add_argument("--manifest", required=True)
    job.set_defaults(run=run_refresh)
    return top


def main(argv: list[str] | None = None) -> str:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("railpulse").getOrCreate()
    outcome = args.run(spark, args)
    print(outcome)
    return outcome


if __name__ == "__main__":
    main()
