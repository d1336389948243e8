"""Collation: raw events -> daily events by provider, route, direction, stop and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.functions import pathcols, timecols
from railpulse.functions.once import evaluated_once
from railpulse.operators.quality import expected_days, missing_days
from railpulse.schemas import DEFAULT_ENABLED, EVENT_COLUMNS
from railpulse.sinks.day_versions import DAY_COLUMNS
from railpulse.sinks.stores import (
    read_daily_table,
    read_run_counts,
    read_run_days,
    write_daily_csv,
    write_daily_table,
)


def yesterday() -> dt.date:
    """The day a run collates by default (UTC)."""
    return (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).date()


def daily_events(raw: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Events with their stop path and service day; day columns now mean the service day.

    The service day follows from the event time, not from the stored ``service_date``.
    An unreadable event time gives a null day.
    """
    day = timecols.service_date(timecols.event_wall_clock(F.col("event_time")))
    path = pathcols.stop_path(F.col("route_id"), F.col("direction_id"), F.col("stop_id"))
    carry = tuple(carry)
    placed = evaluated_once(
        raw.select("provider", *EVENT_COLUMNS, path.alias("stop_path"), *carry), service_day=day)
    return placed.select("provider", *EVENT_COLUMNS, "stop_path", "service_day", *carry).withColumns(
        pathcols.day_parts(F.col("service_day")))


def collated_and_left(
    raw: DataFrame,
    first: dt.date,
    last: dt.date,
    providers: Iterable[str] | None = DEFAULT_ENABLED,
    by_service_day: bool = True,
    late_days: int = 1,
    carry: Iterable[str] = (),
) -> DataFrame:
    """All raw events that a run over a range of days reads, with ``left_out``.

    That is null for events the run keeps, else the reason: ``unreadable_time``, or
    ``other_day`` for a service day outside the range. What was kept and what was left out
    add up to what was read. An event processed more than ``late_days`` after its day is
    read, and reported as ``other_day`` with that day, by the run over its processing day.

    ``raw`` has the raw day as Year, Month and Day; only folders in range are read. ``carry``
    are columns of ``raw`` to keep; ``raw_day`` is the raw day.
    """
    raw_day = F.make_date(*[F.col(c).cast("int") for c in DAY_COLUMNS])
    until = last + dt.timedelta(days=late_days) if by_service_day else last
    wanted = raw.where(raw_day.between(F.lit(first), F.lit(until)))
    if providers is not None:
        wanted = wanted.where(F.col("provider").isin(*providers))
    carry = tuple(carry)
    placed = daily_events(wanted.withColumn("raw_day", raw_day), carry=(*carry, *{"raw_day"} - set(carry)))
    day = F.col("service_day")
    kept = day.between(F.lit(first), F.lit(last))
    if not by_service_day:
        kept = kept & (day == F.col("raw_day"))
    reason = F.when(day.isNull(), F.lit("unreadable_time")).when(~kept, F.lit("other_day"))
    return placed.withColumn("left_out", reason).drop(*{"raw_day"} - set(carry))


def collate_range(
    raw: DataFrame,
    first: dt.date,
    last: dt.date,
    providers: Iterable[str] | None = DEFAULT_ENABLED,
    by_service_day: bool = True,
    late_days: int = 1,
) -> DataFrame:
    """Daily events of a range of days and of several providers, in one job.

    By service day, raw days after a service day are read too, since its first hours
    belong to it. With ``by_service_day=False`` a raw day only feeds the service day of
    the same date, and events of the first hours are left out.
    """
    return collated_and_left(raw, first, last, providers, by_service_day, late_days).where(
        "left_out is null").drop("left_out")


def collation_leftovers(collated: DataFrame) -> DataFrame:
    """Events per provider, reason and service day; rows without a reason were kept."""
    return collated.groupBy("provider", "left_out", "service_day").agg(
        F.count(F.lit(1)).alias("events_count"))


def collation_summary(daily: DataFrame) -> DataFrame:
    """Events and output groups per provider and service day."""
    return daily.groupBy("provider", "service_day").agg(
        F.count(F.lit(1)).alias("events_count"),
        F.count_distinct("stop_path").alias("files_uploaded"),
    )


@dataclass(frozen=True)
class CollationReport:
    """``summary`` of the stored days, ``leftovers``: counts of what was read, and the expected
    days without any raw event. All are read from what the run stored."""

    summary: DataFrame
    leftovers: DataFrame
    missing: DataFrame


def run_collation(
    raw: DataFrame,
    table_root: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    providers: Iterable[str] = DEFAULT_ENABLED,
    by_service_day: bool = True,
    csv_root: str | None = None,
    late_days: int = 1,
) -> CollationReport:
    """Collate and store; every day of the range is replaced for every provider named.

    ``raw`` is read and parsed once: events that are left out, and the raw days, go into the
    same write, and the summary, the counts and the missing days are read from what it stored.
    """
    spark = raw.sparkSession
    first = first or yesterday()
    last = last or first
    providers = list(providers)
    expected = expected_days(spark, first, last, providers)
    covered = expected.select("provider", *[
        f("day").cast("int").alias(name) for name, f in zip(DAY_COLUMNS, (F.year, F.month, F.dayofmonth))])
    collated = collated_and_left(raw, first, last, providers, by_service_day, late_days, carry=("raw_day",))
    run = write_daily_table(collated, table_root, covered)
    day = F.make_date(*DAY_COLUMNS)
    stored = read_daily_table(spark, table_root).where(
        day.between(F.lit(first), F.lit(last)) & F.col("provider").isin(*providers)
    ).withColumn("service_day", day)
    if csv_root is not None:
        write_daily_csv(stored, csv_root, covered)
    seen = read_run_days(spark, table_root, run).where(F.col("day").between(F.lit(first), F.lit(last)))
    return CollationReport(
        collation_summary(stored), read_run_counts(spark, table_root, run), missing_days(expected, seen))


@dataclass(frozen=True)
class ProviderOutcome:
    """What became of one provider's run: its report, or what stopped it."""

    report: CollationReport | None
    error: str | None


def run_collation_apart(
    read_raw: Callable[[str], DataFrame],
    table_root: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    providers: Iterable[str] = DEFAULT_ENABLED,
    **options,
) -> dict[str, ProviderOutcome]:
    """Collate each provider by a run of its own, side by side in the same session.

    ``read_raw(provider)`` gives its raw events. A provider whose events can't be read or
    written has an error and keeps the days it had; the others' days are published.
    """
    def run(provider: str) -> ProviderOutcome:
        try:
            return ProviderOutcome(run_collation(
                read_raw(provider), table_root, first, last, [provider], **options), None)
        except Exception as error:  # whatever stops one provider is reported, and stops no other
            return ProviderOutcome(None, f"{type(error).__name__}: {error}"[:2000])

    providers = list(providers)
    with ThreadPoolExecutor(len(providers)) as pool:
        return dict(zip(providers, pool.map(inheritable_thread_target(run), providers)))
