"""Record layouts shared by the readers, the operators and the writers."""

from __future__ import annotations

from pyspark.sql import types as T

# Provider spellings as the feeds deliver them, and as paths spell them.
AMTRAK = "Amtrak"
VIA = "Via"
BRIGHTLINE = "Brightline"
PROVIDERS = (AMTRAK, VIA, BRIGHTLINE)
DEFAULT_ENABLED = (AMTRAK, VIA)
PROVIDER_PATH_NAMES = {AMTRAK: "Amtrak", VIA: "VIA", BRIGHTLINE: "Brightline"}

# Headsign station -> direction for the feed without direction ids.
BRIGHTLINE_HEADSIGNS = {"EKW": 1, "MCO": 0, "WPT": 1}


def provider_named(name: str) -> str:
    """The provider as data spell it, from any spelling by case; unknown names are refused."""
    for known in PROVIDERS:
        if name.strip().lower() == known.lower():
            return known
    raise ValueError(f"unknown provider {name!r}; known are {', '.join(PROVIDERS)}")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()

# Field names, order and types of the feed's records.
ALERT = _struct(("message", S))

STATION = _struct(
    ("name", S), ("code", S), ("tz", S), ("bus", B),
    ("schArr", S), ("schDep", S), ("arr", S), ("dep", S),
    ("arrCmnt", S), ("depCmnt", S), ("platform", S), ("status", S),
)

TRAIN = _struct(
    ("routeName", S), ("trainNum", S), ("trainNumRaw", S), ("trainID", S),
    ("lat", D), ("lon", D), ("trainTimely", S), ("iconColor", S),
    ("stations", T.ArrayType(STATION)),
    ("heading", S), ("eventCode", S), ("eventTZ", S), ("eventName", S),
    ("origCode", S), ("originTZ", S), ("origName", S),
    ("destCode", S), ("destTZ", S), ("destName", S),
    ("trainState", S), ("velocity", D), ("statusMsg", S),
    ("createdAt", S), ("updatedAt", S), ("lastValTS", S),
    ("objectID", L), ("provider", S), ("providerShort", S),
    ("onlyOfTrainNum", B), ("alerts", T.ArrayType(ALERT)),
)

SNAPSHOT = T.MapType(S, T.ArrayType(TRAIN))

# Fields that may be absent or null; every other field must be present.
OPTIONAL_TRAIN_FIELDS = frozenset({"eventTZ", "eventName", "originTZ", "destTZ", "objectID"})
OPTIONAL_STATION_FIELDS = frozenset({"tz", "arr", "dep"})

# What is left of a train and of a station after the read stage.
TRAIN_KEPT = ("routeName", "trainNumRaw", "destCode", "provider")
STATION_KEPT = ("code", "tz", "bus", "schArr", "schDep", "arr", "dep", "status")
STATION_TIMES = ("arr", "dep", "schArr", "schDep")

# Timetable columns the engine uses; ids stay strings so leading zeros survive.
STOP_TIMES = _struct(
    ("trip_id", S), ("arrival_time", S), ("departure_time", S),
    ("stop_id", S), ("stop_sequence", L),
)
TRIPS = _struct(
    ("route_id", S), ("trip_id", S),
    ("trip_short_name", S), ("direction_id", T.IntegerType()),
)

# Fields of an event, in the order of the CSV files.
EVENT = _struct(
    ("service_date", S), ("route_id", S), ("trip_id", S),
    ("direction_id", T.IntegerType()), ("stop_id", S), ("stop_sequence", L),
    ("vehicle_id", S), ("vehicle_label", S), ("event_type", S),
    ("event_time", S), ("scheduled_headway", L), ("scheduled_tt", L),
)
EVENT_COLUMNS = tuple(EVENT.fieldNames())

# Daily events as stored: the event, its stop path, and the partition columns.
DAILY = T.StructType([
    T.StructField("stop_path", S, True), *EVENT.fields, T.StructField("provider", S, True),
    *[T.StructField(part, T.IntegerType(), True) for part in ("Year", "Month", "Day")],
])

MANIFEST = _struct(("agency", S), ("last_modified", S))
