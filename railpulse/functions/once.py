"""Columns that are computed once a row, however often later steps name them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns whose expressions no filter takes over.

    A filter moves below the projection it reads, and takes a copy of the expression for each
    mention of its column: a text would be parsed ten times a row. No filter moves below a
    generator, so what one gives (here a single row each) is computed once.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(row)))
