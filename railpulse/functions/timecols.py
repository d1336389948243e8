"""Time expressions, Column -> Column.

Instants travel as TIMESTAMP_NTZ holding the UTC wall clock, and every expression
here avoids the session time zone, so results do not change with it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats.
ISO_OFFSET_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:?\d{2})$"
EVENT_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})?$"
HTTP_DATE_SHAPE = r"^[A-Za-z]{3}, \d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} (GMT|UTC)$"
HTTP_DATE_PATTERN = "d MMM yyyy HH:mm:ss z"
DAY_CLOCK_SHAPE = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"
PLAIN_CLOCK_SHAPE = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
LONG_CLOCK_SHAPE = r"^\d{1,3}:[0-5]?\d:[0-5]?\d$"
EASTERN = "America/New_York"
SERVICE_DAY_START_HOUR = 3


def instant_to_utc(ts: Column) -> Column:
    """TIMESTAMP -> UTC wall clock as TIMESTAMP_NTZ, exact through clock changes."""
    seconds = (F.unix_micros(ts).cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def parse_iso(text: Column) -> Column:
    """ISO text with an offset (or ``Z``) -> UTC; anything else -> null."""
    guarded = F.when(text.rlike(ISO_SHAPE), text)
    return instant_to_utc(F.try_to_timestamp(guarded, F.lit(ISO_OFFSET_PATTERN)))


def parse_http_date(text: Column) -> Column:
    """``Wed, 12 Nov 2025 10:00:00 GMT`` -> UTC; anything else -> null."""
    guarded = F.when(text.rlike(HTTP_DATE_SHAPE), F.substr(text, F.lit(6)))
    return instant_to_utc(F.try_to_timestamp(guarded, F.lit(HTTP_DATE_PATTERN)))


def clock_seconds(text: Column, extended_hours: bool = False) -> Column:
    """``HH:MM:SS`` -> second of the day.

    Times from 24:00:00 on become null unless ``extended_hours`` keeps them. Two digits each,
    the common spelling, are read by their places; only others are split.
    """
    shape = LONG_CLOCK_SHAPE if extended_hours else DAY_CLOCK_SHAPE
    hour, minute, second = (F.get(F.split(text, ":"), F.lit(i)).cast("int") for i in range(3))
    places = [F.substr(text, F.lit(i), F.lit(2)).cast("int") for i in (1, 4, 7)]
    return F.when(
        text.rlike(PLAIN_CLOCK_SHAPE), places[0] * 3600 + places[1] * 60 + places[2]
    ).when(text.rlike(shape), hour * 3600 + minute * 60 + second)


def whole_second(ts: Column) -> Column:
    """Drop the fraction of a second from a TIMESTAMP_NTZ.

    By intervals, which are whole numbers of microseconds: the rest of a decimal is divided out.
    """
    whole = F.second(ts) * F.expr("interval '1' second")
    return ts - (F.make_dt_interval(secs=F.date_part(F.lit("SECOND"), ts)) - whole)


def service_date(
    ts: Column, zone: str = "UTC", start_hour: int = SERVICE_DAY_START_HOUR
) -> Column:
    """Date of the service day: it runs from ``start_hour`` to ``start_hour`` next day.

    ``ts`` is a UTC wall clock; for another ``zone`` its local wall clock decides.
    """
    wall = ts if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return (wall - F.make_dt_interval(hours=F.lit(start_hour))).cast("date")


def iso_text(ts: Column) -> Column:
    """UTC wall clock -> ``YYYY-MM-DDTHH:MM:SS+00:00``."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def event_wall_clock(text: Column) -> Column:
    """Wall clock written in an event time; the offset plays no part in its service day."""
    guarded = F.when(text.rlike(EVENT_TIME_SHAPE), F.substr(text, F.lit(1), F.lit(19)))
    return guarded.try_cast("timestamp_ntz")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, 0 when there is nothing to divide by."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))
