"""From nested snapshots to flat station rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.functions import timecols
from railpulse.schemas import STATION, STATION_KEPT, STATION_TIMES, TRAIN, TRAIN_KEPT
from railpulse.sources.snapshots import typed_leaf


def flatten_trains(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per train of every document; the train number used as key is dropped.

    Scalars get their types here; ``stations`` and ``alerts`` stay nested. ``carry`` are
    columns of the document to keep.
    """
    # The outer form spares the parse: a plain explode would filter on the map first,
    # and that filter would evaluate it a second time. Null groups go one step later.
    groups = parsed.select(*carry, F.explode_outer("trains").alias("train_number", "group"))
    trains = groups.select(*carry, F.explode("group").alias("train"))
    return trains.select(*carry, *_typed_fields(trains.schema["train"].dataType, TRAIN, F.col("train")))


def keep_train_columns(trains: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The train columns that later stages need, and the stations."""
    return trains.select(*carry, *TRAIN_KEPT, "stations")


def explode_stations(trains: DataFrame) -> DataFrame:
    """One row per station of every train; a train without stations keeps one null row."""
    carried = [c for c in trains.columns if c != "stations"]
    stops = trains.select(*carried, F.explode_outer("stations").alias("station"))
    fields = _typed_fields(stops.schema["station"].dataType, STATION, F.col("station"))
    return stops.select(*carried, *fields)


def parse_station_times(stops: DataFrame) -> DataFrame:
    """The four station times as UTC; unreadable text becomes null."""
    return stops.withColumns({c: timecols.parse_iso(F.col(c)) for c in STATION_TIMES})


def keep_station_columns(stops: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The columns of a station row after the read stage."""
    return stops.select(*carry, *TRAIN_KEPT, *STATION_KEPT)


def station_rows(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Nested documents -> flat station rows, all five steps above."""
    trains = keep_train_columns(flatten_trains(parsed, carry), carry)
    return keep_station_columns(parse_station_times(explode_stations(trains)), carry)


def add_service_dates(stops: DataFrame) -> DataFrame:
    """``service_date_arr`` and ``service_date_dep`` as ISO text."""
    return stops.withColumns({
        f"service_date_{c}": timecols.service_date(F.col(c)).cast("string") for c in ("arr", "dep")
    })


def preview(stops: DataFrame, rows: int = 10) -> DataFrame:
    """First rows by departure, those without one last, for a look at the service dates."""
    shown = ("trainNumRaw", "code", "arr", "service_date_arr", "dep", "service_date_dep")
    return stops.orderBy(F.col("dep").asc_nulls_last(), "trainNumRaw", "code").select(*shown).limit(rows)


def _typed_fields(actual: T.StructType, wanted: T.StructType, owner: Column) -> list[Column]:
    out = []
    for field in wanted:
        leaf = owner[field.name]
        if isinstance(actual[field.name].dataType, T.VariantType):
            leaf = typed_leaf(leaf, field.dataType)
        out.append(leaf.alias(field.name))
    return out
