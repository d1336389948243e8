"""Small control tables: the cutoff of the last run and the timetable manifest.

Every write adds a commit, a folder of its own with one file, so writers never touch each
other's files. A commit holds the rows it changes and those it found, each with the moment it
was set; of the rows of a key the latest counts. So writers of different keys that run side by
side both persist, and of one key the later one wins. A commit that has been taken over is
removed after ``GRACE``, when no reader can have it listed any more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.schemas import MANIFEST
from railpulse.sources import files, runs

CUTOFF = T.StructType([
    T.StructField("datetime", T.StringType(), True),
    # Of a stream: the batch that moved the cutoff here, and where it was before.
    T.StructField("batch", T.LongType(), True),
    T.StructField("before", T.StringType(), True),
])
GRACE = dt.timedelta(hours=1)


def _latest(spark: SparkSession, path: str, layout: T.StructType, key: Sequence[str]) -> DataFrame:
    """Rows of the newest commit of each key, with ``set_at``."""
    with_moment = T.StructType([*layout.fields, T.StructField("set_at", T.LongType(), True)])
    try:
        rows = spark.read.schema(T.StructType(
            [*with_moment.fields, T.StructField("commit", T.StringType(), True)])).json(path)
    except AnalysisException:
        return spark.createDataFrame([], with_moment)
    fields = with_moment.fieldNames()
    newest = rows.where("set_at is not null").groupBy(*key).agg(
        F.max_by(F.struct(*fields), F.struct("set_at", "commit")).alias("row"))
    return newest.where("row is not null").select("row.*")


def read_state(spark: SparkSession, path: str, layout: T.StructType, key: Sequence[str] = ()) -> DataFrame:
    """The current rows, one per key (without a key: one); an absent table is empty."""
    return _latest(spark, path, layout, key).drop("set_at")


def write_state(rows: DataFrame, path: str, layout: T.StructType, key: Sequence[str] = ()) -> None:
    """Set these rows; those of other keys stay.

    One task writes one file, which appears all at once: control tables have a row per agency.
    """
    spark, path, run = rows.sparkSession, path.rstrip("/"), runs.new_run()
    found = files.listed(spark, path)
    known = _latest(spark, path, layout, key)
    # After what is known, even if that was set by a faster clock.
    set_at = max(runs.moment(), 1 + (known.agg(F.max("set_at")).first()[0] or 0))
    changed = rows.select(*layout.fieldNames(), F.lit(set_at).alias("set_at"))
    others = known.join(rows.select(*key), list(key), "left_anti") if key else known.limit(0)
    others.select(changed.columns).unionAll(changed).coalesce(1).write.json(f"{path}/commit={run}")
    before = runs.began(run) - int(GRACE.total_seconds() * 1e6)
    for name in found:
        if name.startswith("commit=") and runs.began(name.removeprefix("commit=")) < before:
            files.remove(spark, f"{path}/{name}")


def _moment(text: str | None) -> dt.datetime | None:
    try:
        moment = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except (TypeError, AttributeError, ValueError):
        return None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return moment.astimezone(dt.timezone.utc)


def read_cutoff(
    spark: SparkSession, path: str, batch: int | None = None
) -> dt.datetime | None:
    """Time of the last run in UTC; None on a first run or when the state is unreadable.

    A batch that is run again after it moved the cutoff gets the cutoff it had before.
    """
    stored = read_state(spark, path, CUTOFF).first()
    if stored is None:
        return None
    repeated = batch is not None and stored["batch"] == batch
    return _moment(stored["before"] if repeated else stored["datetime"])


def write_cutoff(
    spark: SparkSession, path: str, moment: dt.datetime | None = None,
    batch: int | None = None, before: dt.datetime | None = None,
) -> dt.datetime:
    """Store the time of this run (now, unless given) and return it."""
    moment = moment or dt.datetime.now(dt.timezone.utc)
    row = (moment.isoformat(), batch, before.isoformat() if before else None)
    write_state(spark.createDataFrame([row], CUTOFF), path, CUTOFF)
    return moment


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Last known modification date per agency; empty when there is none yet."""
    return read_state(spark, path, MANIFEST, ["agency"])


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Set the dates of these agencies; others keep theirs."""
    write_state(manifest, path, MANIFEST, ["agency"])
