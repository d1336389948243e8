"""The given tables seen as timetables, station rows and snapshot documents.

Every view reads its whole table and derives values by arithmetic that any SQL engine
repeats, so results can be compared with plain SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.functions import pathcols, timecols
from railpulse.functions.once import evaluated_once
from railpulse.operators.service_days import WEEKDAYS
from railpulse.plans.ingest import TimetableTables, generate_events, new_departures
from railpulse.schemas import AMTRAK, BRIGHTLINE, PROVIDERS, VIA

# Headsign table for the third provider, in the stop codes of these views.
HEADSIGNS = {"S002": 1, "S005": 0, "S008": 1}
EVENTS_PER_DOCUMENT = 8
FUTURE_DOCUMENT = """[{"routeName": "Route 9", "trainNum": "9", "trainNumRaw": "9", "trainID": "9",
    "lat": 1, "lon": 1, "trainTimely": "", "iconColor": "", "heading": "N", "eventCode": "S999",
    "origCode": "S999", "origName": "", "destCode": "S999", "destName": "", "trainState": "Active",
    "velocity": 1, "statusMsg": "", "createdAt": "", "updatedAt": "", "lastValTS": "",
    "provider": "Amtrak", "providerShort": "A", "onlyOfTrainNum": true, "alerts": [],
    "stations": [{"name": "", "code": "S999", "bus": false, "schArr": "", "schDep": "", "arrCmnt": "",
        "depCmnt": "", "platform": "", "status": "Departed", "dep": "2035-06-01T12:00:00Z"}]}]"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clock_text(seconds: Column) -> Column:
    """Second of the day -> ``HH:MM:SS``; hours may exceed 23, up to 99.

    All digits are written as one whole number, of which a leading 1 keeps the zeros.
    """
    hours, minutes = (F.call_function("div", seconds, F.lit(n)) for n in (3600, 60))
    digits = (F.lit(1000000) + hours * 10000 + minutes % 60 * 100 + seconds % 60).cast("string")
    return F.concat_ws(":", *[F.substr(digits, F.lit(i), F.lit(2)) for i in (2, 4, 6)])


def stop_code(number: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(number.cast("string"), 3, "0"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trips; those of pending orders have no stop times, some lack a direction."""
    direction = F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey") % 2).cast("int")
    pending = F.when(F.col("o_orderstatus") == "P", F.lit("P")).otherwise(F.lit(""))
    return table(spark, sf_dir, "orders").select(
        F.concat(pending, F.col("o_orderkey").cast("string")).alias("trip_id"),
        F.col("o_orderpriority").alias("route_id"),
        direction.alias("direction_id"),
        (F.col("o_custkey") % 60 * 2).cast("string").alias("trip_short_name"),
        F.col("o_orderkey").alias("ord"),
    )


def stop_times(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    """Line items as stop times, on demand with the row position in the file as ``ord``."""
    seconds = (
        F.col("l_orderkey") * 7919 % 79200 + F.col("l_linenumber") * 1800 + F.col("l_partkey") % 60
    )
    clock = clock_text(seconds)
    sequence = (
        F.col("l_linenumber") * F.lit(10**17) + F.col("l_partkey") * 10**6 + F.col("l_suppkey")
    )
    position = F.struct("_metadata.file_path", "_metadata.row_index").alias("ord")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        *([position] if positions else []))
    return lines.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        clock.alias("arrival_time"),
        clock.alias("departure_time"),
        stop_code(F.col("l_suppkey") % 40).alias("stop_id"),
        sequence.alias("stop_sequence"),
        *(["ord"] if positions else []),
    )


def service_calendar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Regions as services with weekday patterns of a month, nations as exceptions on three days.

    Service 0 runs daily, 1 on working days, 2 on weekends, 3 by exception only, 4 on working days
    of the first half.
    """
    region = F.col("r_regionkey")
    works, rests = region.isin(0, 1, 4).cast("int"), region.isin(0, 2).cast("int")
    calendar = table(spark, sf_dir, "region").select(
        region.alias("service_id"),
        *[(works if k < 5 else rests).alias(name) for k, name in enumerate(WEEKDAYS)],
        F.lit("2024-01-01").cast("date").alias("start_date"),
        F.when(region == 4, F.lit("2024-01-15")).otherwise(F.lit("2024-01-31")).cast("date").alias("end_date"))
    nation = F.col("n_nationkey")
    exceptions = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("service_id"),
        F.date_add(F.lit("2024-01-06").cast("date"), F.expr("n_nationkey div 10").cast("int")).alias("date"),
        (nation % 2 + 1).cast("int").alias("exception_type"))
    return calendar, exceptions


def station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flat station rows."""
    user, event = F.col("user_id"), F.col("event_id")
    dep = timecols.whole_second(F.col("ts"))
    dwell = F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        user.cast("string").alias("trainNumRaw"),
        F.concat(F.lit("Route "), (user % 7).cast("string")).alias("routeName"),
        stop_code(event % 45).alias("code"),
        stop_code(user % 45).alias("destCode"),
        F.when(user % 3 == 0, F.lit(AMTRAK)).when(user % 3 == 1, F.lit(VIA))
        .otherwise(F.lit(BRIGHTLINE)).alias("provider"),
        (F.col("event_type") == "error").alias("bus"),
        F.when(F.col("event_type") == "view", F.lit("Enroute"))
        .otherwise(F.lit("Departed")).alias("status"),
        F.when(event % 11 != 0, dep - dwell).alias("arr"),
        F.when(event % 19 != 0, dep).alias("dep"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshot documents: up to eight events with consecutive ids share one.

    A document has a list of trains per train number, a train the stations of up to four
    of the events; purchases are trains without stations yet.
    """
    rows = station_rows(spark, sf_dir)
    empty = F.lit("")
    planned = F.coalesce(timecols.iso_text(F.col("dep")), F.lit("unknown"))

    def zulu(column: str) -> Column:
        return F.replace(timecols.iso_text(F.col(column)), F.lit("+00:00"), F.lit("Z"))

    station = F.struct(
        F.concat(F.col("code"), F.lit(" station")).alias("name"), "code",
        F.lit("America/Toronto").alias("tz"), "bus",
        planned.alias("schArr"), planned.alias("schDep"),
        zulu("arr").alias("arr"), timecols.iso_text(F.col("dep")).alias("dep"),
        empty.alias("arrCmnt"), empty.alias("depCmnt"), empty.alias("platform"), "status",
    )
    # Events of one train: same document, provider, train number and kind.
    train_key = ["document_id", "trainNumRaw", "routeName", "destCode", "provider", "event_type"]
    numbered = rows.withColumn("document_id", F.expr(f"event_id div {EVENTS_PER_DOCUMENT}"))
    grouped = numbered.groupBy(*train_key).agg(
        F.min("event_id").alias("first_event"),
        F.array_sort(F.collect_list(F.struct("event_id", station.alias("station")))).alias("listed"))
    stations = F.when(F.col("event_type") != "purchase", F.transform("listed", lambda x: x["station"]))
    stations = F.coalesce(stations, F.transform(
        F.filter("listed", lambda x: F.lit(False)), lambda x: x["station"]))
    train = F.struct(
        "routeName", F.col("trainNumRaw").alias("trainNum"), "trainNumRaw",
        F.col("first_event").cast("string").alias("trainID"),
        F.lit(45.5).alias("lat"), F.lit(-73).alias("lon"),
        empty.alias("trainTimely"), empty.alias("iconColor"), stations.alias("stations"),
        F.lit("N").alias("heading"), F.lit("S000").alias("eventCode"),
        F.lit("S000").alias("origCode"), empty.alias("origName"),
        "destCode", empty.alias("destName"), F.lit("Active").alias("trainState"),
        F.lit(60.5).alias("velocity"), empty.alias("statusMsg"),
        empty.alias("createdAt"), empty.alias("updatedAt"), empty.alias("lastValTS"),
        F.col("first_event").alias("objectID"), "provider", F.lit("X").alias("providerShort"),
        F.lit(True).alias("onlyOfTrainNum"),
        F.array(F.struct(F.lit("on time").alias("message"))).alias("alerts"),
    )
    trains = grouped.groupBy("document_id", "trainNumRaw").agg(
        F.array_sort(F.collect_list(F.struct("first_event", train.alias("train")))).alias("sorted"))
    entry = F.struct(F.col("trainNumRaw").alias("key"),
                     F.transform("sorted", lambda x: x["train"]).alias("value"))
    return trains.groupBy("document_id").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("value"))


def spoiled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents damaged in one of five ways, by number, and how many faults each has then.

    Each station without code, and each train whose number is no text, is one fault;
    text after the document makes it unreadable as a whole, which is one.
    """
    kind, text = F.col("document_id") % 5, F.col("value")
    spoiled = (
        F.when(kind == 0, F.regexp_replace(text, '"code":"S', '"kode":"S'))
        .when(kind == 1, F.regexp_replace(text, '"trainNumRaw":"(\\d+)"', '"trainNumRaw":$1'))
        .when(kind == 2, F.concat(text, F.lit(" tail")))
        .when(kind == 3, F.regexp_replace(text, '"velocity":60.5', '"velocity":"60.5","new":1'))
        .otherwise(text))
    return documents(spark, sf_dir).withColumn("value", spoiled)


def timetable_tables(spark: SparkSession, sf_dir: str) -> TimetableTables:
    return TimetableTables.build(stop_times(spark, sf_dir), trips(spark, sf_dir))


def generated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all three providers; the third gets its direction from headsigns."""
    return generate_events(
        new_departures(station_rows(spark, sf_dir)), timetable_tables(spark, sf_dir),
        PROVIDERS, {BRIGHTLINE: HEADSIGNS})


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated events as read from the raw store: processed on their calendar day."""
    day = timecols.event_wall_clock(F.col("event_time")).cast("date")
    return evaluated_once(generated_events(spark, sf_dir), raw_day=day).withColumns(
        pathcols.day_parts(F.col("raw_day"))).drop("raw_day")


def manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as agencies: (HTTP date headers now, manifest so far).

    Poor accounts send no date; machinery and building have moved on by a day;
    furniture is not in the manifest yet.
    """
    customers = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    day = (F.col("c_custkey") % 28 + 1).cast("int")
    moved = F.when(segment.isin("MACHINERY", "BUILDING"), F.lit(1)).otherwise(F.lit(0))
    now = F.date_add(F.make_date(F.lit(2025), F.lit(11), day), moved)
    header = F.concat(F.date_format(now, "EEE, dd MMM yyyy"), F.lit(" 10:00:00 GMT"))
    headers = customers.select(
        F.col("c_name").alias("agency"),
        F.when(F.col("c_acctbal") >= 0, header).alias("last_modified"))
    known = F.concat(
        F.make_date(F.lit(2025), F.lit(11), day).cast("string"), F.lit("T10:00:00"))
    cached = customers.where(segment != "FURNITURE").select(
        F.col("c_name").alias("agency"), known.alias("last_modified"))
    return headers, cached
