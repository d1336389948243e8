"""Stored raw events: gzip JSON, partitioned by provider and processing day."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.schemas import EVENT, EVENT_COLUMNS, PROVIDER_PATH_NAMES

RAW_FILES = "*.json.gz"
BLANKS = " \t\r\n"
DOCUMENTS = "source string, value string, error string"
LANDED_DAY = r"/([^/]+)/Year=(\d+)/Month=(\d+)/Day=(\d+)/"

# Every field as text: one mistyped value must not spoil its neighbours.
RAW_EVENT = T.StructType([T.StructField(c, T.StringType(), True) for c in EVENT_COLUMNS])


def read_raw_events(spark: SparkSession, root: str) -> DataFrame:
    """Events this engine wrote: one JSON object per line, unreadable lines dropped.

    A line holding a whole array reads the same. Partition columns (provider, Year,
    Month, Day) come with the rows, and filters on them prune folders.
    """
    return _parsed_lines(spark.read.option("pathGlobFilter", RAW_FILES).text(root))


def read_raw_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The same of some files of the store at ``root``; nothing else of it is listed."""
    return _parsed_lines(spark.read.option("basePath", root).text(paths))


def _parsed_lines(lines: DataFrame) -> DataFrame:
    rows = parse_event_documents(lines)
    if "provider" in rows.columns:
        rows = rows.withColumn("provider", _provider_from_path(F.col("provider")))
    return rows


def read_event_documents(spark: SparkSession, root: str) -> DataFrame:
    """Landed files from elsewhere, one row per file: ``source``, ``value`` and ``error``.

    A file that is cut off or damaged has an error and no value, and stops no other.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", RAW_FILES)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "content")
    )
    return files.mapInArrow(_unpacked, DOCUMENTS)


def unpack(packed: bytes) -> tuple[str | None, str | None]:
    """Text of gzip members, or what is wrong with them; no bytes at all are an empty text."""
    parts, rest = [], packed
    try:
        while rest:
            machine = zlib.decompressobj(31)
            parts.append(machine.decompress(rest))
            if not machine.eof:
                return None, "file is cut off"
            rest = machine.unused_data
        return b"".join(parts).decode("utf-8"), None
    except (zlib.error, UnicodeDecodeError) as error:
        return None, str(error)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            value, error = unpack(content.as_py())
            yield pa.RecordBatch.from_pydict({
                "source": [path.as_py()], "value": pa.array([value], pa.string()),
                "error": pa.array([error], pa.string())})


def broken_files(docs: DataFrame) -> DataFrame:
    """The files that could not be unpacked, with the reason."""
    return docs.where("error is not null").select("source", "error")


def parse_event_documents(docs: DataFrame) -> DataFrame:
    """Events of texts that hold an array or a single object.

    Empty, blank and invalid texts yield nothing; the text is parsed as the only
    element of an array, so trailing text makes it invalid.
    """
    # Only texts with blanks at an end are trimmed, and one that doesn't end as it begins fails at
    # its end: it need not be read up to there.
    value = F.col("value")
    trimmed = F.btrim(value, F.lit(BLANKS))
    listed = F.when(value.startswith("{"), F.lit(False)).otherwise(trimmed.startswith("["))
    wrapped = F.when(value.startswith("{") & value.endswith("}"), F.concat(F.lit("[["), value, F.lit("]]"))).when(
        trimmed.startswith("[") & trimmed.endswith("]"), F.concat(F.lit("["), value, F.lit("]"))).when(
        trimmed.startswith("{") & trimmed.endswith("}"), F.concat(F.lit("[["), value, F.lit("]]")))
    carried = [c for c in docs.columns if c not in ("value", "error")]
    # Apart from its uses, and exploded in the outer form, so that it is parsed once.
    parsed = docs.select(*carried, listed.alias("_listed"), F.from_json(
        wrapped, T.ArrayType(T.ArrayType(RAW_EVENT))).alias("_lists"))
    inner = F.get("_lists", F.lit(0))
    sound = (F.size("_lists") == 1) & (F.col("_listed") | (F.size(inner) == 1))
    rows = parsed.select(*carried, F.explode_outer(F.when(sound, inner)).alias("event"))
    return typed_events(rows.where(F.col("event").isNotNull()).select(*carried, "event.*"))


def with_landed_day(rows: DataFrame) -> DataFrame:
    """Provider and processing day from the path of a landed file."""
    def part(i: int) -> Column:
        return F.regexp_extract(F.col("source"), LANDED_DAY, i)

    days = {name: part(i).try_cast("int") for i, name in enumerate(("Year", "Month", "Day"), 2)}
    return rows.withColumns({"provider": _provider_from_path(part(1)), **days})


def typed_events(rows: DataFrame) -> DataFrame:
    """Text fields -> event types; values of the wrong type become null."""
    return rows.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in EVENT})


def _provider_from_path(name: Column) -> Column:
    names = F.create_map(*[F.lit(x) for x in chain(
        *((path, provider) for provider, path in PROVIDER_PATH_NAMES.items()))])
    return F.coalesce(F.try_element_at(names, name), name)
