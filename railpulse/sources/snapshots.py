"""Snapshot documents: landed JSON files, one map of train number -> trains each.

A document is parsed once, with VARIANT leaves, so that the check below sees the
JSON types as they were written (a typed parse would turn ``5`` into ``"5"``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.functions.once import evaluated_once
from railpulse.functions.timecols import instant_to_utc
from railpulse.schemas import (
    OPTIONAL_STATION_FIELDS,
    OPTIONAL_TRAIN_FIELDS,
    STATION,
    TRAIN,
)

# Texts that count as a boolean.
TRUE_WORDS = ("1", "t", "true", "y", "yes", "on")
FALSE_WORDS = ("0", "f", "false", "n", "no", "off")
WHOLE_NUMBER_SHAPE = r"^\s*[+-]?\d+(\.0*)?\s*$"


def _loose(kind: T.DataType) -> T.DataType:
    """The same nesting with every scalar as VARIANT."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), True) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType))
    return T.VariantType()


LOOSE_SNAPSHOT = T.MapType(T.StringType(), T.ArrayType(_loose(TRAIN)))


def read_snapshots(
    spark: SparkSession, path: str, one_per_line: bool = False,
    landed_after: dt.datetime | None = None,
) -> DataFrame:
    """Landed snapshots, one row each: ``source``, ``landed_at``, ``value``.

    A file is one document, or with ``one_per_line`` a splittable batch of them. With
    ``landed_after`` older files are only listed, not read.
    """
    reader = spark.read
    if landed_after is not None:
        moment = landed_after.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("modifiedAfter", moment).option("timeZone", "UTC")
    return _document_columns(reader.text(path, wholetext=not one_per_line))


def stream_snapshots(
    spark: SparkSession, path: str, one_per_line: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same rows as a file stream."""
    reader = spark.readStream.format("text").option("wholetext", not one_per_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _document_columns(reader.load(path))


def _document_columns(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("_metadata.file_path").alias("source"),
        instant_to_utc(F.col("_metadata.file_modification_time")).alias("landed_at"),
        "value",
    )


def parse_snapshots(docs: DataFrame) -> DataFrame:
    """Add ``trains`` (map of lists, null if the document is not one) and ``violations``.

    The text is parsed as the only element of an array, so trailing text makes the
    document malformed instead of being ignored.
    """
    wrapped = F.from_json(
        F.concat(F.lit("["), F.col("value"), F.lit("]")), T.ArrayType(LOOSE_SNAPSHOT)
    )
    # Apart from its uses, so that the parse is evaluated once.
    parsed = docs.withColumn("_wrapped", wrapped).withColumn(
        "trains", F.when(F.size("_wrapped") == 1, F.get("_wrapped", F.lit(0))))
    return evaluated_once(parsed, violations=_violations(F.col("trains"))).drop("_wrapped")


def accepted_snapshots(parsed: DataFrame) -> DataFrame:
    """Blank out the trains of rejected documents: they yield no rows further on.

    Done by value, not by a filter, so that the parse is not evaluated a second time
    for a pushed-down predicate.
    """
    return parsed.withColumn("trains", F.when(F.col("violations") == 0, F.col("trains")))


def rejected_snapshots(parsed: DataFrame) -> DataFrame:
    """Quarantine: the documents that failed, with their number of violations."""
    return parsed.where(F.col("violations") > 0).drop("trains")


def _violations(trains: Column) -> Column:
    per_list = F.transform(
        F.map_values(trains),
        lambda group: F.when(group.isNull(), F.lit(1)).otherwise(
            F.aggregate(group, F.lit(0), lambda acc, train: acc + _train_violations(train))
        ),
    )
    total = F.aggregate(per_list, F.lit(0), lambda acc, n: acc + n)
    return F.coalesce(total, F.lit(1))


def _train_violations(train: Column) -> Column:
    stations = F.aggregate(
        train["stations"], F.lit(0), lambda acc, s: acc + _struct_violations(
            s, STATION, OPTIONAL_STATION_FIELDS)
    )
    alerts = F.aggregate(
        train["alerts"], F.lit(0), lambda acc, a: acc + _broken(a["message"], T.StringType(), False)
    )
    own = _struct_violations(train, TRAIN, OPTIONAL_TRAIN_FIELDS)
    # A missing or wrongly shaped list makes its sum null.
    return own + F.coalesce(stations, F.lit(1)) + F.coalesce(alerts, F.lit(1))


# How the kind of a leaf is written where no look at its value is needed.
PLAIN_KINDS = {
    "string": "STRING",
    "double": r"(DOUBLE|BIGINT|DECIMAL\(\d+,\d+\))",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
}


def _struct_violations(value: Column, layout: T.StructType, optional: frozenset[str]) -> Column:
    """Leaves that do not hold what they should, plus one for a missing struct.

    The kinds of all leaves are asked for once and matched as one text; only where that
    leaves doubts, each leaf is looked at.
    """
    scalars = [f for f in layout if not isinstance(f.dataType, T.ArrayType)]
    absent = F.lit("ABSENT")
    kinds = F.concat_ws(",", *[F.coalesce(F.schema_of_variant(value[f.name]), absent) for f in scalars])
    plain = ",".join(
        f"({PLAIN_KINDS[f.dataType.simpleString()]}|ABSENT|VOID)" if f.name in optional
        else PLAIN_KINDS[f.dataType.simpleString()] for f in scalars)
    total = F.when(value.isNull(), F.lit(1)).otherwise(F.lit(0))
    for field in scalars:
        total = total + _broken(value[field.name], field.dataType, field.name in optional)
    return F.when(kinds.rlike(f"^{plain}$"), F.lit(0)).otherwise(total)


def _broken(leaf: Column, wanted: T.DataType, optional: bool) -> Column:
    """1 if the leaf does not hold a value of the wanted kind, else 0."""
    kind = F.schema_of_variant(leaf)
    good = _accepts(leaf, kind, wanted)
    if optional:
        good = leaf.isNull() | (kind == "VOID") | good
    return F.when(F.coalesce(good, F.lit(False)), F.lit(0)).otherwise(F.lit(1))


def _accepts(leaf: Column, kind: Column, wanted: T.DataType) -> Column:
    text = F.try_variant_get(leaf, "$", "string")
    number = F.try_variant_get(leaf, "$", "double")
    numeric = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    if isinstance(wanted, T.StringType):
        return kind == "STRING"
    if isinstance(wanted, T.DoubleType):
        return numeric | (kind == "BOOLEAN") | ((kind == "STRING") & number.isNotNull())
    if isinstance(wanted, T.LongType):
        return (
            (kind == "BOOLEAN")
            | (numeric & (number == F.floor(number)))
            | ((kind == "STRING") & text.rlike(WHOLE_NUMBER_SHAPE))
        )
    return (
        (kind == "BOOLEAN")
        | (numeric & number.isin(0.0, 1.0))
        | ((kind == "STRING") & F.lower(text).isin(*TRUE_WORDS, *FALSE_WORDS))
    )


def typed_leaf(leaf: Column, wanted: T.DataType) -> Column:
    """VARIANT leaf -> SQL value of the wanted kind."""
    if isinstance(wanted, T.BooleanType):
        word = F.lower(F.try_variant_get(leaf, "$", "string"))
        return (
            F.when(word.isin(*TRUE_WORDS, "1.0"), F.lit(True))
            .when(word.isin(*FALSE_WORDS, "0.0"), F.lit(False))
        )
    return F.try_variant_get(leaf, "$", wanted.simpleString())
