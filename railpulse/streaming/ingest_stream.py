"""Ingest as a stream over the landing folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railpulse.functions import timecols
from railpulse.operators.events import SAME_REPORT, dedupe_events
from railpulse.plans.ingest import TimetableTables, generate_events, read_stage
from railpulse.schemas import DEFAULT_ENABLED, EVENT_COLUMNS
from railpulse.sinks.stores import DAY_COLUMNS, write_quarantine, write_raw_events
from railpulse.sources import state
from railpulse.sources.snapshots import parse_snapshots, rejected_snapshots

CADENCE = "5 minutes"
LATENESS = "26 hours"
FILES_PER_BATCH = 2


def event_stream(
    docs: DataFrame, tables: TimetableTables, enabled: Iterable[str] = DEFAULT_ENABLED
) -> DataFrame:
    """Streaming snapshots -> streaming events; timetable tables join as static sides."""
    return generate_events(read_stage(docs), tables, enabled)


def first_reports(
    events: DataFrame, keys: Sequence[str] = SAME_REPORT, lateness: str = LATENESS
) -> DataFrame:
    """Drop repeated reports; state is bounded by a watermark on the landing time.

    The feed's own times may lie anywhere and move nothing. A snapshot is late only if it
    landed that long before one already read, which files read in landing order never are.
    """
    # The watermark needs a TIMESTAMP; only differences of it matter.
    timed = events.withColumn("landed_clock", F.col("landed_at").cast("timestamp"))
    return (
        timed.withWatermark("landed_clock", lateness)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("landed_clock")
    )


def write_event_stream(
    events: DataFrame, root: str, checkpoint: str, once: bool = False, cadence: str = CADENCE,
    files: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Deduplicated events to a Parquet store by provider and calendar day, exactly once.

    A micro-batch is brought together in few ``files`` per folder before it is written. Folders
    are dealt to tasks, so that a batch of many days after a pause is not written by few.
    """
    day = timecols.event_wall_clock(F.col("event_time")).cast("date")
    placed = events.select(
        "provider", *EVENT_COLUMNS,
        F.year(day).alias("Year"), F.month(day).alias("Month"), F.dayofmonth(day).alias("Day")
    ).repartition("provider", *DAY_COLUMNS, F.pmod(F.xxhash64(*SAME_REPORT), F.lit(files)))
    writer = (
        placed.writeStream.format("parquet").outputMode("append")
        .option("path", root).option("checkpointLocation", checkpoint)
        .partitionBy("provider", *DAY_COLUMNS)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=cadence)
    return writer.start()


def start_cutoff_ingest(
    docs: DataFrame,
    tables: TimetableTables | Callable[[], TimetableTables],
    raw_root: str,
    state_path: str,
    checkpoint: str,
    enabled: Iterable[str] = DEFAULT_ENABLED,
    once: bool = False,
    cadence: str = CADENCE,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Micro-batches with the cutoff rule: departures up to the last run are ignored.

    A batch may hold several snapshots after a pause; the same report in two of them
    is stored once. A batch is stored under its own number and its landing day, and the
    state row keeps the cutoff from before it: a batch that is run again after a failure
    sees what it saw the first time and replaces itself. The cutoff moves after the events
    are safe. Where ``tables`` is a function, each batch loads what is current then.
    """
    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        landed = batch.agg(F.max("landed_at")).first()[0]
        if landed is None:
            return
        cutoff = state.read_cutoff(spark, state_path, number)
        current = tables() if callable(tables) else tables
        events = dedupe_events(generate_events(read_stage(batch, cutoff), current, enabled))
        write_raw_events(events, raw_root, landed, batch=f"stream-{number}")
        if quarantine is not None:
            write_quarantine(rejected_snapshots(parse_snapshots(batch)), quarantine, f"stream-{number}")
        state.write_cutoff(
            spark, state_path, landed.replace(tzinfo=dt.timezone.utc), number, cutoff)

    writer = docs.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=cadence)
    return writer.start()
