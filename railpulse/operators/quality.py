"""Counts that describe a run: the ingest funnel and days without data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.operators.filters import DEPARTED, utc_literal
from railpulse.schemas import PROVIDERS


def funnel_columns(cutoff: dt.datetime | str | None = None) -> list[Column]:
    """Counts of station rows after each read stage and per provider.

    Their names are fixed values, those of the published run metrics.
    """
    fresh = F.lit(True) if cutoff is None else F.coalesce(
        F.col("dep") > utc_literal(cutoff), F.lit(False))
    departed = F.coalesce(~F.col("bus") & (F.col("status") == DEPARTED), F.lit(False))
    kept = fresh & departed

    def rows(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    return [
        F.count(F.lit(1)).alias("station_rows"),
        rows(fresh, "rows_after_time_filter"),
        rows(kept, "rows_after_bus_removal"),
        *[rows(kept & (F.col("provider") == p), f"rows_{p.lower()}") for p in PROVIDERS],
    ]


def ingest_funnel(stops: DataFrame, cutoff: dt.datetime | str | None = None) -> DataFrame:
    """The funnel's counts, from one pass over station rows."""
    return stops.agg(*funnel_columns(cutoff))


def snapshot_columns() -> list[Column]:
    """Counts of documents, rejected documents and trains of the accepted ones."""
    trains = F.aggregate(
        F.map_values("trains"), F.lit(0), lambda acc, group: acc + F.size(group))
    return [
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("violations") > 0).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("violations") == 0, trains)), F.lit(0)).alias("trains"),
    ]


def snapshot_counts(parsed: DataFrame) -> DataFrame:
    return parsed.agg(*snapshot_columns())


def expected_days(
    spark: SparkSession, first: dt.date, last: dt.date, providers: Sequence[str] = PROVIDERS
) -> DataFrame:
    """Every (provider, day) of a range."""
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(p) for p in providers])).alias("provider"),
        days.alias("days"),
    ).select("provider", F.explode("days").alias("day"))


def missing_days(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """The expected (provider, day) pairs without any raw event, flagged 1."""
    seen = observed.select("provider", "day").distinct()
    return expected.join(seen, ["provider", "day"], "left_anti").withColumn(
        "missing_day", F.lit(1))
