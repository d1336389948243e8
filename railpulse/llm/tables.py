"""Tables in and between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from railpulse.session import shared_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: what follows neither repeats the work when it needs the rows twice,
    nor when executors are lost.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def least_hashes(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """The ``most`` rows with the least hash of ``by[0]``, ties by the rest.

    The task that orders them gets little more than that from all partitions together: rows are
    sifted by their hash first, to the share that holds so many of them unless values repeat.
    """
    total = rows.count()
    share = (most + 8 * most ** 0.5) / max(total, 1)
    value = F.xxhash64(by[0])
    if share < 1:
        rows = rows.where(value < int(share * 2 ** 64) - 2 ** 63)
    return rows.orderBy(value, *by[1:]).limit(most)


def whole_text(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
