"""Shards cut from the Hilbert curve over document metadata.

Language, source, length and size become grid coordinates: categories by a hash, numbers by
their logarithm. Rows sorted by the curve index of their grid point are cut into runs of
equal numbers of rows (law ``rows``: counts differ by one at most), so that every shard
covers a compact box of the metadata and filters on any of the columns skip most shards.

Only ids and numbers are sorted; texts stay where they are until shards are written. Ties on
the curve are broken by id and checksum, so a value that a third of all rows share is cut
like any other. Null texts have no bytes; nulls in other columns have a coordinate of their
own. Repeated rows are kept. Columns other than id, text, lang and source are ignored; the
last two may be missing.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.window import Window

from railpulse.llm.hilbert import hilbert_index
from railpulse.llm.tables import stored

BITS = 10


def _category(column: Column) -> Column:
    return F.when(column.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(column), F.lit((1 << BITS) - 1)))


def _logarithm(number: Column, per_doubling: int) -> Column:
    grid = F.floor(F.log2(1.0 + F.coalesce(number, F.lit(0))) * per_doubling)
    return F.least(grid, F.lit((1 << BITS) - 1))


def with_curve_index(docs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, lang, source, curve_index`` of every document, and ``carried``."""
    text = F.col("text").cast("string")
    column = {c: F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in ("lang", "source")}
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    rows = docs.select(
        F.col("doc_id"), size.alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        *[c.alias(name) for name, c in column.items()], *carried,
        _category(column["lang"]).alias("_x"), _category(column["source"]).alias("_y"),
        _logarithm(F.char_length(text), 24).alias("_z"),
        # How much of a text lies outside ASCII: 0 to 1023 for one to four bytes a character.
        F.coalesce(F.least(F.floor((F.try_divide(F.octet_length(text), F.char_length(text)) - 1) * 341),
                           F.lit(1023)), F.lit(0)).alias("_w"))

    @F.pandas_udf("long")
    def index(x: pd.Series, y: pd.Series, z: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy(np.int64) for c in (x, y, z, w)], 1), BITS))

    return rows.withColumn("curve_index", index("_x", "_y", "_z", "_w")).drop("_x", "_y", "_z", "_w")


def with_shards(indexed: DataFrame, n_shards: int = 24) -> DataFrame:
    """Adds ``shard`` and ``slot`` (the place in it): an exact rank on the curve, cut evenly."""
    order = [F.col("curve_index"), F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    # The ranges are sampled, so they are stored before anything is counted by them.
    ranged = stored(indexed.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition of the range shuffle, which is what may be joined by broadcast.
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_rows")).withColumn(
        "_before", F.coalesce(before, F.lit(0)))
    total = ranged.count()
    ranked = (ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
              .join(F.broadcast(parts.select("_part", "_before")), "_part")
              .withColumn("_rank", (F.col("_before") + F.col("_place")).cast("long")))
    # Shard s holds the ranks from floor(s * total / n) up to the next such bound.
    shard = F.expr(f"cast((_rank * {n_shards} + {n_shards - 1}) div {max(total, 1)} as int)")
    first = F.expr(f"(shard * {total}L) div {n_shards}")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - first).drop(
        "_part", "_place", "_before", "_rank")


def write_shards(docs: DataFrame, path: str, n_shards: int = 24) -> None:
    """Whole documents under ``shard=…`` folders in the order of their slots.

    Rows are numbered and stored first and get their shard by that number, so rows with a null
    id and rows that repeat an id are written like all others. Columns ``shard``, ``slot`` and
    ``_row`` of the documents are replaced.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot", "_row")]
    numbered = stored(docs.select(*own, F.monotonically_increasing_id().alias("_row")), "numbered")
    assigned = with_shards(with_curve_index(numbered, carried=("_row",)), n_shards).select("_row", "shard", "slot")
    # Both sides grow with the documents, so neither is broadcast.
    (numbered.join(assigned.hint("merge"), "_row").drop("_row")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
