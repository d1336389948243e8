"""Row filters; each stays a plain predicate that the optimizer can push down."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.functions import timecols
from railpulse.schemas import DEFAULT_ENABLED, PROVIDERS

DEPARTED = "Departed"


def newer_than(
    df: DataFrame, cutoff: dt.datetime | str | None, column: str = "dep"
) -> DataFrame:
    """Rows strictly after the cutoff (UTC); without a cutoff every row, nulls included."""
    if cutoff is None:
        return df
    return df.where(F.col(column) > utc_literal(cutoff))


def utc_literal(moment: dt.datetime | str) -> Column:
    """A UTC wall-clock literal; aware datetimes are converted, naive ones taken as UTC."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment.replace("Z", "+00:00"))
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def departed_rail(df: DataFrame) -> DataFrame:
    """Stops a train (not a replacement bus) has left."""
    return df.where(~F.col("bus") & (F.col("status") == DEPARTED))


def known_providers(df: DataFrame) -> DataFrame:
    """Rows of the three providers; others vanish."""
    return df.where(F.col("provider").isin(*PROVIDERS))


def enabled_providers(df: DataFrame, enabled: Iterable[str] = DEFAULT_ENABLED) -> DataFrame:
    """Rows of the providers that are switched on."""
    return df.where(F.col("provider").isin(*enabled))


def service_day(
    stored: DataFrame, day: dt.date | None = None, provider_part: str | None = None
) -> DataFrame:
    """Stored events of one service day, by partition values only.

    The default day is the current one on the Eastern wall clock.
    """
    if day is None:
        now = timecols.instant_to_utc(F.current_timestamp())
        wanted = timecols.service_date(now, zone=timecols.EASTERN)
        keep = F.make_date("Year", "Month", "Day") == wanted
    else:
        keep = (F.col("Year") == day.year) & (F.col("Month") == day.month) & (
            F.col("Day") == day.day)
    if provider_part is not None:
        keep = keep & F.col("provider").contains(provider_part)
    return stored.where(keep)
