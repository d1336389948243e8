"""Stores whose days are replaced whole, by versions and pointers to the current ones.

A run writes its rows under a folder named after itself; then it adds a pointer to itself for
every (provider, day) it covers, with rows or without, each in a folder of its own. Of the
pointers of a day the one added last counts. So a day that has become empty is empty, a run that
dies before its pointers changes nothing, and one that runs again replaces itself. Runs never
replace or remove each other's files: side by side, runs over different days or providers all
persist, and of runs over the same day the one that finishes last. ``remove_superseded`` clears
away what no pointer names any more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.sources import files, runs

DAY_COLUMNS = ("Year", "Month", "Day")
KEY = ("provider", *DAY_COLUMNS)
POINTERS = T.StructType([
    T.StructField("set_at", T.LongType(), True),
    T.StructField("provider", T.StringType(), True),
    *[T.StructField(part, T.IntegerType(), True) for part in DAY_COLUMNS],
    T.StructField("stored_version", T.StringType(), True),
])


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(POINTERS).json(f"{root}/current")
    except AnalysisException:
        return spark.createDataFrame([], POINTERS)


def _current(pointers: DataFrame) -> DataFrame:
    return pointers.groupBy(*KEY).agg(
        F.max_by("stored_version", F.struct("set_at", "stored_version")).alias("stored_version"))


def current_versions(spark: SparkSession, root: str, folders: list[str]) -> dict[tuple, str]:
    """The current version of each key whose folder of pointers is named; no other is listed."""
    if not folders:
        return {}
    rows = spark.read.schema(POINTERS).option("basePath", f"{root.rstrip('/')}/current").json(folders)
    return {tuple(row[c] for c in KEY): row["stored_version"] for row in _current(rows).collect()}


def publish_days(
    spark: SparkSession, root: str, covered: DataFrame, write: Callable[[str], None]
) -> str:
    """Write a version by ``write(folder)`` and make it current for ``covered`` days.

    ``covered`` has ``provider, Year, Month, Day``, a row per day; the name of the version is
    returned. What takes time is the number of pointers' folders, so all tasks of a shuffle make
    them, which adaptive execution must not join for being small; each is made by one.
    """
    root, run = root.rstrip("/"), runs.new_run()
    write(version_folder(root, run))
    # Only folders of this run's name are replaced, and no temporary folder is shared.
    covered.select(F.lit(runs.moment()).alias("set_at"), *KEY, F.lit(run).alias("stored_version")).repartition(
        shuffle_tasks(spark), *KEY).distinct().write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*KEY, "stored_version").json(f"{root}/current")
    return run


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def version_folder(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/data/stored_version={run}"


def current_days(
    spark: SparkSession, root: str, read: Callable[[str], DataFrame], empty: T.StructType
) -> DataFrame:
    """Rows of the current versions. ``read(folder)`` reads all versions with the key columns;
    filters on those prune folders, and so do the pointers."""
    root = root.rstrip("/")
    if not files.listed(spark, f"{root}/current"):
        return spark.createDataFrame([], empty)
    return read(f"{root}/data").join(
        _current(_pointers(spark, root)), [*KEY, "stored_version"], "left_semi").drop("stored_version")


def remove_superseded(spark: SparkSession, root: str, older_than: dt.timedelta) -> list[str]:
    """Remove versions that began before that and are current for no day, with their pointers.

    Readers and runs that began since then are not disturbed. The names of versions and the
    pointers of removed ones come to the driver, a few per run.
    """
    root = root.rstrip("/")
    pointers = _pointers(spark, root)
    current = {row["stored_version"] for row in _current(pointers).select("stored_version").distinct().collect()}
    before = runs.moment() - int(older_than.total_seconds() * 1e6)
    found = [name.removeprefix("stored_version=") for name in files.listed(spark, f"{root}/data")]
    gone = [run for run in found if run not in current and 0 < runs.began(run) < before]
    for row in pointers.where(F.col("stored_version").isin(gone)).collect() if gone else []:
        files.remove(spark, f"{root}/current/provider={row['provider']}/Year={row['Year']}/Month={row['Month']}/"
                            f"Day={row['Day']}/stored_version={row['stored_version']}")
    for run in gone:
        files.remove(spark, version_folder(root, run))
    return gone
