"""Timetable refresh: which bundles to fetch, and the manifest afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.functions import timecols
from railpulse.operators.manifest import changed_timetables, merged_manifest
from railpulse.sources import state


def dates_from_headers(headers: DataFrame) -> DataFrame:
    """``agency`` and HTTP date text -> manifest rows; no or unreadable date gives null."""
    moment = timecols.parse_http_date(F.col("last_modified"))
    return headers.select(
        "agency", F.replace(moment.cast("string"), F.lit(" "), F.lit("T")).alias("last_modified"))


def run_refresh(headers: DataFrame, manifest_path: str) -> list[str]:
    """Agencies whose bundle must be fetched; only their dates are set in the manifest, so
    that refreshes of other agencies may run meanwhile.

    The list has one name per agency, a handful of control values.
    """
    current = dates_from_headers(headers)
    cached = state.read_manifest(headers.sparkSession, manifest_path)
    changes = changed_timetables(current, cached)
    changed = [r["agency"] for r in changes.select("agency").collect()]
    if changed:
        state.write_manifest(merged_manifest(current, cached).join(
            changes.select("agency"), "agency", "left_semi"), manifest_path)
    return sorted(changed)
