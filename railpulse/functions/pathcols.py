"""Expressions for the partition layout of stored events."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from railpulse.schemas import PROVIDER_PATH_NAMES

# Fixed value: how a missing part of a stop path is written.
MISSING_PART = "None"


def stop_path(route: Column, direction: Column, stop: Column) -> Column:
    """``route_direction_stop``; a null part is written out, not skipped."""
    parts = [F.coalesce(c.cast("string"), F.lit(MISSING_PART)) for c in (route, direction, stop)]
    return F.concat_ws("_", *parts)


def provider_path_name(provider: Column) -> Column:
    """Provider as paths spell it; unknown providers keep their own name."""
    names = F.create_map(*[F.lit(x) for x in chain(*PROVIDER_PATH_NAMES.items())])
    return F.coalesce(F.try_element_at(names, provider), provider)


def day_parts(day: Column) -> dict[str, Column]:
    """Year, month and day columns of a date, as partition values."""
    return {"Year": F.year(day), "Month": F.month(day), "Day": F.dayofmonth(day)}
