"""Raw events compacted by day: few sorted files, and an index of them, beside the batch folders.

The raw store gets a folder per batch. ``compact_raw_days`` rewrites the batches of given days as
Parquet files sorted by event time, as a version of those days (see ``day_versions``). Every
version lists the raw files it was made from, and its own files with their first and last event
time. The raw store stays as it is.

``read_raw_days`` reads a range of days from both: it lists the folders of those days and no
others, takes the compacted files (of which a time range leaves out what lies outside), and the
raw files that came later. A day of which a raw file is gone, since its batch ran again, is read
from its raw files until it is compacted anew. So what is read is always what the raw store holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from railpulse.functions import timecols
from railpulse.functions.once import evaluated_once
from railpulse.schemas import EVENT, EVENT_COLUMNS, PROVIDER_PATH_NAMES
from railpulse.sinks.day_versions import KEY, POINTERS, current_versions, publish_days, shuffle_tasks, version_folder
from railpulse.sources import files, raw_events

FILES = T.StructType([
    T.StructField("made_from", T.BooleanType(), True),
    T.StructField("file", T.StringType(), True),
    T.StructField("first_time", T.TimestampNTZType(), True),
    T.StructField("last_time", T.TimestampNTZType(), True),
    T.StructField("events", T.LongType(), True),
    T.StructField("untimed", T.LongType(), True),
    *[f for f in POINTERS if f.name in KEY],
])
COMPACTED = T.StructType([*EVENT.fields, *[f for f in POINTERS if f.name in KEY]])
Key = tuple[str, int, int, int]


@dataclass(frozen=True)
class DayFiles:
    """What one provider's day is read from: compacted files, and raw ones."""

    compacted: list[str]
    raw: list[str]


def _keys(first: dt.date, last: dt.date, providers: Iterable[str]) -> list[Key]:
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    return [(provider, day.year, day.month, day.day) for provider in providers for day in days]


def _raw_folder(spark: SparkSession, key: Key) -> str:
    provider, year, month, day = key
    name = files.escaped(spark, PROVIDER_PATH_NAMES.get(provider, provider))
    return f"provider={name}/Year={year}/Month={month:02d}/Day={day:02d}"


def _folder(spark: SparkSession, key: Key) -> str:
    provider, year, month, day = key
    return f"provider={files.escaped(spark, provider)}/Year={year}/Month={month}/Day={day}"


def _raw_files(spark: SparkSession, raw_root: str, keys: list[Key]) -> dict[Key, list[str]]:
    """Raw files of each day, by their path below the store; only those days' folders are listed."""
    folders = [_raw_folder(spark, key) for key in keys]
    trees = files.of_each(lambda folder: files.tree(spark, f"{raw_root}/{folder}"), folders)
    return {key: [f"{folder}/{name}" for name in names if name.endswith(".json.gz")]
            for key, folder, names in zip(keys, folders, trees)}


def _existing(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    paths = list(paths)
    return {path for path, there in zip(paths, files.of_each(lambda path: files.exists(spark, path), paths)) if there}


def _frame(spark: SparkSession, rows: list[tuple], types: T.StructType) -> DataFrame:
    """Names as a frame, by Arrow: plain Python rows would start a Python worker on every core."""
    return spark.createDataFrame(pa.table(
        [pa.array(values, to_arrow_type(field.dataType)) for values, field in zip(zip(*rows), types)],
        names=types.names), types)


def _wall_clock() -> Column:
    return timecols.event_wall_clock(F.col("event_time"))


def compact_raw_days(
    spark: SparkSession, raw_root: str, root: str, first: dt.date, last: dt.date, providers: Iterable[str]
) -> str | None:
    """Compact the raw files of a range of days; the version's name, or None if there are none.

    The rebalance hint splits a heavy day and joins light ones; the names of raw files, which
    Spark lists to read them anyway, come to the driver. Days without raw files become empty.
    """
    raw_root, root = raw_root.rstrip("/"), root.rstrip("/")
    listed = _raw_files(spark, raw_root, _keys(first, last, providers))
    paths = sorted(path for own in listed.values() for path in own)
    if not paths:
        return None
    key_types = T.StructType([f for f in POINTERS if f.name in KEY])
    covered = _frame(spark, list(listed), key_types)
    sources = _frame(spark, [(path, *key) for key, own in listed.items() for path in own],
                     T.StructType([FILES["file"], *key_types]))

    def write(folder: str) -> None:
        rows = raw_events.read_raw_files(spark, raw_root, [f"{raw_root}/{path}" for path in paths]).select(
            *EVENT_COLUMNS, *KEY)
        (rows.hint("rebalance", *KEY).withColumn("_time", _wall_clock())
         .sortWithinPartitions(*KEY, "_time").drop("_time")
         .write.mode("overwrite").partitionBy(*KEY).parquet(f"{folder}/events"))
        written = spark.read.schema(COMPACTED).parquet(f"{folder}/events").withColumn("_time", _wall_clock())
        made = written.groupBy(*KEY, F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).agg(
            F.min("_time").alias("first_time"), F.max("_time").alias("last_time"),
            F.count("*").alias("events"), F.count_if(F.col("_time").isNull()).alias("untimed"))
        index = sources.withColumn("made_from", F.lit(True)).unionByName(
            made.withColumn("made_from", F.lit(False)), allowMissingColumns=True)
        # A folder per day, made by all tasks: what takes time is their number.
        index.repartition(shuffle_tasks(spark), *KEY).write.mode("overwrite").partitionBy(*KEY).parquet(f"{folder}/files")

    return publish_days(spark, root, covered, write)


def day_files(
    spark: SparkSession,
    raw_root: str,
    root: str,
    first: dt.date,
    last: dt.date,
    providers: Iterable[str],
    since: dt.datetime | None = None,
    before: dt.datetime | None = None,
) -> dict[Key, DayFiles]:
    """The files that each provider's day is read from, as whole paths.

    ``since`` and ``before`` leave out compacted files without any event in that range of event
    times; files that hold an unreadable time are always read.
    """
    raw_root, root = raw_root.rstrip("/"), root.rstrip("/")
    listed = _raw_files(spark, raw_root, _keys(first, last, providers))
    pointed = [f"{root}/current/{_folder(spark, key)}" for key in listed]
    versions = current_versions(spark, root, sorted(_existing(spark, pointed)))
    # A version that covers a day without raw files has no index for it.
    places = {key: f"{version_folder(root, run)}/files/{_folder(spark, key)}" for key, run in versions.items()}
    there = _existing(spark, places.values())
    indexes = {key: path for key, path in places.items() if path in there}
    found = {key: DayFiles([], list(own)) for key, own in listed.items()}
    by_key: dict[Key, list] = {}
    for run in sorted({versions[key] for key in indexes}):
        base = f"{version_folder(root, run)}/files"
        own = [path for key, path in indexes.items() if versions[key] == run]
        for row in spark.read.schema(FILES).option("basePath", base).parquet(*own).collect():
            by_key.setdefault(tuple(row[c] for c in KEY), []).append(row)
    for key, rows in by_key.items():
        sources = {row["file"] for row in rows if row["made_from"]}
        if not sources <= set(listed[key]):
            continue  # a batch ran again since
        folder = f"{version_folder(root, versions[key])}/events/{_folder(spark, key)}"
        wanted = [row["file"] for row in rows if not row["made_from"] and (row["untimed"] or (
            (since is None or row["last_time"] >= since) and (before is None or row["first_time"] < before)))]
        found[key] = DayFiles([f"{folder}/{name}" for name in wanted],
                              [path for path in listed[key] if path not in sources])
    return {key: DayFiles(own.compacted, [f"{raw_root}/{path}" for path in own.raw]) for key, own in found.items()}


def read_raw_days(
    spark: SparkSession,
    raw_root: str,
    root: str,
    first: dt.date,
    last: dt.date,
    providers: Iterable[str],
    since: dt.datetime | None = None,
    before: dt.datetime | None = None,
) -> DataFrame:
    """Raw events of these days (processing days, inclusive), with provider, Year, Month and Day.

    With ``since`` or ``before``, only events from the first and before the second (wall clock,
    UTC), and those of an unreadable time.
    """
    root = root.rstrip("/")
    found = day_files(spark, raw_root, root, first, last, providers, since, before).values()
    raw = [path for own in found for path in own.raw]
    rows = raw_events.read_raw_files(spark, raw_root.rstrip("/"), raw).select(*COMPACTED.names) if raw else (
        spark.createDataFrame([], COMPACTED))
    by_run: dict[str, list[str]] = {}
    for own in found:
        for path in own.compacted:
            by_run.setdefault(path.split("/events/")[0], []).append(path)
    for folder, paths in sorted(by_run.items()):
        rows = rows.unionByName(
            spark.read.schema(COMPACTED).option("basePath", f"{folder}/events").parquet(*paths))
    if since is None and before is None:
        return rows
    rows, time = evaluated_once(rows, _time=_wall_clock()), F.col("_time")
    if since is not None:
        rows = rows.where(time.isNull() | (time >= F.lit(since.isoformat()).cast("timestamp_ntz")))
    if before is not None:
        rows = rows.where(time.isNull() | (time < F.lit(before.isoformat()).cast("timestamp_ntz")))
    return rows.drop("_time")
