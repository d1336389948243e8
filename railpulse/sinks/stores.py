"""Writers for raw events, the daily event table and its CSV export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.functions.pathcols import provider_path_name
from railpulse.schemas import DAILY, EVENT, EVENT_COLUMNS
from railpulse.sinks.day_versions import DAY_COLUMNS, current_days, publish_days, version_folder

RAW_ROWS_PER_FILE = 2_000_000


def write_raw_events(
    events: DataFrame, root: str, processed_at: dt.datetime | Column, batch: int | str = 0
) -> None:
    """Append a run to the raw store: gzip JSON lines by provider and processing day.

    ``batch`` names the run; writing the same run again replaces it instead of adding
    a second copy. The rebalance hint keeps the number of files in proportion.
    """
    if isinstance(processed_at, dt.datetime):
        processed_at = F.lit(processed_at.strftime("%Y-%m-%d")).cast("date")
    padded = {
        "Year": F.year(processed_at).cast("string"),
        "Month": F.lpad(F.month(processed_at).cast("string"), 2, "0"),
        "Day": F.lpad(F.dayofmonth(processed_at).cast("string"), 2, "0"),
    }
    (
        events.select(provider_path_name(F.col("provider")).alias("provider"), *EVENT_COLUMNS,
                      *[c.alias(name) for name, c in padded.items()],
                      F.lit(str(batch)).alias("batch"))
        .hint("rebalance", "provider", *DAY_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("ignoreNullFields", False)
        .option("maxRecordsPerFile", RAW_ROWS_PER_FILE)
        .partitionBy("provider", *DAY_COLUMNS, "batch")
        .json(root)
    )


def write_daily_table(daily: DataFrame, root: str, covered: DataFrame) -> str:
    """Daily events as Parquet by provider and service day, ordered by stop path.

    The days in ``covered`` are replaced whole, also those without events now. The
    rebalance hint lets adaptive execution split a heavy day and join light ones.

    With columns ``left_out`` and ``service_day``, rows that have a reason in the first go to
    a part of the same version that no reader of the table sees, without their events: so
    one pass stores what is kept and counts what is not. ``raw_day`` is stored where it is
    given. The version's name is returned.
    """
    layout = ["kept", "provider", *DAY_COLUMNS]
    daily = daily.withColumns({name: F.lit(None).cast(kind) for name, kind in (
        ("left_out", "string"), ("service_day", "date"), ("raw_day", "date")) if name not in daily.columns})
    kept = F.col("left_out").isNull()
    rows = (
        daily.select(*[F.when(kept, F.col(c)).alias(c) for c in ("stop_path", *EVENT_COLUMNS, *DAY_COLUMNS)],
                     "provider", "raw_day", "left_out", F.when(~kept, F.col("service_day")).alias("left_day"),
                     kept.alias("kept"))
        .hint("rebalance", *layout)
        .sortWithinPartitions(*layout, "stop_path")
    )
    return publish_days(daily.sparkSession, root, covered, lambda folder: rows.write.mode(
        "overwrite").partitionBy(*layout).parquet(folder))


def read_run_counts(spark: SparkSession, root: str, run: str) -> DataFrame:
    """``provider, left_out, service_day, events_count`` of what one run read: rows without a
    reason were kept. Of those only the folders' names are read."""
    layout = T.StructType([
        T.StructField("left_out", T.StringType(), True), T.StructField("left_day", T.DateType(), True),
        T.StructField("kept", T.BooleanType(), True),
        *[DAILY[c] for c in ("provider", *DAY_COLUMNS)]])
    rows = spark.read.schema(layout).parquet(version_folder(root, run))
    kept = rows.where("kept").select(
        "provider", F.lit(None).cast("string").alias("left_out"), F.make_date(*DAY_COLUMNS).alias("service_day"))
    left = rows.where("not kept").select("provider", "left_out", F.col("left_day").alias("service_day"))
    return kept.unionAll(left).groupBy("provider", "left_out", "service_day").agg(
        F.count(F.lit(1)).alias("events_count"))


def read_run_days(spark: SparkSession, root: str, run: str) -> DataFrame:
    """The ``provider`` and raw ``day`` of what one run read, each once."""
    layout = T.StructType([T.StructField("raw_day", T.DateType(), True), T.StructField("kept", T.BooleanType(), True),
                           *[DAILY[c] for c in ("provider", *DAY_COLUMNS)]])
    return spark.read.schema(layout).parquet(version_folder(root, run)).select(
        "provider", F.col("raw_day").alias("day")).distinct()


def write_daily_csv(daily: DataFrame, root: str, covered: DataFrame) -> None:
    """Daily events as gzip CSV with header, one folder per provider, stop path and day.

    What takes time is the number of files, not of rows, so rows are dealt by stop path to all
    tasks of a shuffle, which adaptive execution must not join for being small. One task makes the
    folders above the days of a month, and the commit moves them at once.
    """
    layout = ["provider", "stop_path", *DAY_COLUMNS]
    spelled = provider_path_name(F.col("provider"))
    tasks = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        daily.withColumn("provider", spelled)
        .select(*EVENT_COLUMNS, *layout)
        .repartition(tasks, "provider", "stop_path", "Year", "Month")
    )
    publish_days(
        daily.sparkSession, root, covered.withColumn("provider", spelled),
        lambda folder: rows.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("compression", "gzip").partitionBy(*layout).csv(folder))


def read_daily_table(spark: SparkSession, root: str) -> DataFrame:
    """The stored daily events; a store without any day yet is empty."""
    layout = T.StructType([*DAILY.fields, T.StructField("kept", T.BooleanType(), True),
                           T.StructField("stored_version", T.StringType(), True)])
    return current_days(spark, root, lambda folder: spark.read.schema(layout).parquet(folder).where(
        "kept").drop("kept"), DAILY)


def read_daily_csv(spark: SparkSession, root: str) -> DataFrame:
    """The current CSV files, with provider names as paths spell them."""
    layout = T.StructType([
        *EVENT.fields, *[DAILY[c] for c in ("provider", "stop_path", *DAY_COLUMNS)],
        T.StructField("stored_version", T.StringType(), True)])
    return current_days(
        spark, root,
        lambda folder: spark.read.schema(layout).option("header", True).option("escape", '"').csv(folder),
        T.StructType(layout.fields[:-1]))


def write_quarantine(rejected: DataFrame, root: str, batch: int | str) -> None:
    """Documents that a check rejected, as gzip JSON lines under the run's name."""
    (
        rejected.withColumn("batch", F.lit(str(batch)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("batch")
        .json(root)
    )
