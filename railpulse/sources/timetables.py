"""Timetable bundles: CSV text files, or tables already stored as Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.schemas import STOP_TIMES, TRIPS


def read_stop_times(spark: SparkSession, bundle: str) -> DataFrame:
    """``stop_times.txt`` of a bundle folder, times as text, with file order ``ord``."""
    return _read_csv(spark, f"{bundle.rstrip('/')}/stop_times.txt", STOP_TIMES)


def read_trips(spark: SparkSession, bundle: str) -> DataFrame:
    """``trips.txt`` of a bundle folder, with file order ``ord``."""
    return _read_csv(spark, f"{bundle.rstrip('/')}/trips.txt", TRIPS)


def read_bundles(
    spark: SparkSession, bundles: Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Stop times and trips of several providers (provider -> folder) in one frame each.

    Bundles are read apart because their column order differs, then united by name.
    """
    def united(read) -> DataFrame:
        frames = [
            read(spark, path).withColumn("provider", F.lit(provider))
            for provider, path in bundles.items()
        ]
        return reduce(DataFrame.unionByName, frames)

    return united(read_stop_times), united(read_trips)


def read_table(spark: SparkSession, path: str, positions: bool = True) -> DataFrame:
    """A timetable table stored as Parquet; ``ord`` is its stable row position.

    Without ``positions`` the scan does not produce them: the means do not need any.
    """
    rows = spark.read.parquet(path)
    if not positions:
        return rows
    return rows.withColumn("ord", F.struct("_metadata.file_path", "_metadata.row_index"))


def _read_csv(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """Columns by header name, in any order; columns the bundle leaves out are null.

    ``ord`` is taken at the scan, before any shuffle, and grows in file order.
    """
    # A quote inside a quoted cell is doubled, as the published format says.
    lines = spark.read.option("header", True).option("escape", '"').csv(path)
    present = {name.strip().lstrip("\ufeff"): name for name in lines.columns}
    fields = []
    for field in layout:
        if field.name in present:
            cell = F.col(f"`{present[field.name]}`").try_cast(field.dataType)
        else:
            cell = F.lit(None).cast(field.dataType)
        fields.append(cell.alias(field.name))
    position = F.struct(
        "_metadata.file_path", "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("row"))
    return lines.select(*fields, position.alias("ord"))
