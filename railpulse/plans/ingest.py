"""Ingest: snapshots and timetables -> arrival and departure events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.operators import enrich, events, filters, quality, reshape, timetable
from railpulse.schemas import BRIGHTLINE, BRIGHTLINE_HEADSIGNS, DEFAULT_ENABLED, PROVIDERS
from railpulse.sinks.stores import write_quarantine, write_raw_events
from railpulse.sources import runs, snapshots, state

HEADSIGNS = {BRIGHTLINE: BRIGHTLINE_HEADSIGNS}
LANDED = ("landed_at",)
TABLE_NAMES = ("means", "by_train_number", "by_last_stop")
TABLE_VERSION = T.StructType([T.StructField("tables", T.StringType(), True)])


@dataclass(frozen=True)
class TimetableTables:
    """What ingest needs of the timetables; ``feed`` names the key columns they share.

    ``per_stop`` is what two of the tables are read from, where they were built together.
    """

    means: DataFrame
    by_train_number: DataFrame
    by_last_stop: DataFrame
    feed: tuple[str, ...] = ()
    per_stop: DataFrame | None = None

    @classmethod
    def build(
        cls, stop_times: DataFrame, trips: DataFrame, feed: Sequence[str] = ()
    ) -> TimetableTables:
        means, by_last_stop, per_stop = timetable.means_and_last_stop_directions(stop_times, trips, feed)
        return cls(means, timetable.direction_by_train_number(trips, feed), by_last_stop, tuple(feed), per_stop)

    def save(self, root: str) -> None:
        """Store the tables, so that each run reads them instead of the timetables.

        They go to a folder named after the run, and one state row makes all three current
        at once; what was loaded from an earlier version stays readable, and of saves that
        run side by side the later one counts. The rows per stop are kept meanwhile, a row each,
        so that the stop times are read once.
        """
        spark, root, run = self.means.sparkSession, root.rstrip("/"), runs.new_run()
        if self.per_stop is not None:
            self.per_stop.persist()
        try:
            for name in TABLE_NAMES:
                getattr(self, name).write.mode("overwrite").parquet(f"{root}/version={run}/{name}")
        finally:
            if self.per_stop is not None:
                self.per_stop.unpersist()
        state.write_state(
            spark.createDataFrame([(run,)], TABLE_VERSION), f"{root}/current", TABLE_VERSION)

    @classmethod
    def load(cls, spark: SparkSession, root: str, feed: Sequence[str] = ()) -> TimetableTables:
        root = root.rstrip("/")
        current = state.read_state(spark, f"{root}/current", TABLE_VERSION).first()
        if current is None:
            raise FileNotFoundError(f"no timetable tables under {root}")
        means, by_number, by_stop = (
            spark.read.parquet(f"{root}/version={current['tables']}/{name}") for name in TABLE_NAMES)
        return cls(means, by_number, by_stop, tuple(feed))


def new_departures(stops: DataFrame, cutoff: dt.datetime | str | None = None) -> DataFrame:
    """Station rows that make events: past the cutoff, departed, rail, known provider."""
    return filters.known_providers(filters.departed_rail(filters.newer_than(stops, cutoff)))


def read_stage(docs: DataFrame, cutoff: dt.datetime | str | None = None) -> DataFrame:
    """Snapshot documents -> station rows ready to enrich; rejected documents yield none."""
    return new_departures(_station_rows(snapshots.parse_snapshots(docs)), cutoff)


def _station_rows(parsed: DataFrame) -> DataFrame:
    """Station rows of the accepted documents, with the landing time where it is known."""
    return reshape.station_rows(
        snapshots.accepted_snapshots(parsed), [c for c in LANDED if c in parsed.columns])


def enriched_stops(
    stops: DataFrame, tables: TimetableTables,
    headsigns: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Station rows with direction, schedule metrics and service dates."""
    directed = enrich.with_direction(
        stops, tables.by_train_number, tables.by_last_stop, tables.feed, headsigns)
    return reshape.add_service_dates(
        enrich.with_scheduled_metrics(directed, tables.means, tables.feed))


def generate_events(
    stops: DataFrame,
    tables: TimetableTables,
    enabled: Iterable[str] = DEFAULT_ENABLED,
    headsigns: Mapping[str, Mapping[str, int]] | None = HEADSIGNS,
) -> DataFrame:
    """Events of the enabled providers, all in one job."""
    wanted = filters.enabled_providers(stops, enabled)
    return events.arr_dep_events(enriched_stops(wanted, tables, headsigns), _carried(stops))


def _carried(stops: DataFrame) -> list[str]:
    return ["provider", *[c for c in LANDED if c in stops.columns]]


@dataclass(frozen=True)
class IngestReport:
    """What a run did; the counts were taken while the events were written."""

    cutoff: dt.datetime
    snapshots: dict[str, int]
    funnel: dict[str, int]
    directions: dict[str, float]
    metrics: dict[str, float]
    events: dict[str, int]


def event_count_columns() -> list[Column]:
    kind = F.col("event_type")
    return [
        F.count_if(kind == "ARR").alias("arrivals"),
        F.count_if(kind == "DEP").alias("departures"),
        *[F.count_if(F.col("provider") == p).alias(f"events_{p.lower()}") for p in PROVIDERS],
    ]


def run_ingest(
    docs: DataFrame, tables: TimetableTables, raw_root: str, state_path: str,
    enabled: Iterable[str] = DEFAULT_ENABLED, now: dt.datetime | None = None,
    quarantine: str | None = None,
) -> IngestReport:
    """One batch run: events after the stored cutoff go to the raw store, then the
    cutoff moves to ``now``. No job runs for the counts alone.

    Snapshots repeat what they reported before; of equal reports the earliest landed is
    kept. Rejected documents are counted, and written to ``quarantine`` if there are any.
    """
    spark = docs.sparkSession
    now = now or dt.datetime.now(dt.timezone.utc)
    cutoff = state.read_cutoff(spark, state_path)
    seen, funnel, directions, metrics, written = (
        Observation(name) for name in ("snapshots", "funnel", "directions", "metrics", "events"))
    parsed = snapshots.parse_snapshots(docs)
    stops = _station_rows(parsed.observe(seen, *quality.snapshot_columns())).observe(
        funnel, *quality.funnel_columns(cutoff))
    wanted = filters.enabled_providers(new_departures(stops, cutoff), enabled)
    enriched = (
        enriched_stops(wanted, tables, HEADSIGNS)
        .observe(directions, *enrich.direction_match_columns())
        .observe(metrics, *enrich.metric_match_columns())
    )
    fresh = events.dedupe_events(events.arr_dep_events(enriched, _carried(enriched))).observe(
        written, *event_count_columns())
    batch = now.strftime("%H%M%S")
    write_raw_events(fresh, raw_root, now, batch=batch)
    if quarantine is not None and seen.get["rejected"]:
        write_quarantine(snapshots.rejected_snapshots(parsed), quarantine, now.strftime("%Y%m%d-%H%M%S"))
    state.write_cutoff(spark, state_path, now)
    return IngestReport(now, seen.get, funnel.get, directions.get, metrics.get, written.get)
