"""Names, existence and removal of folders, by the file system Spark itself uses for a path."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item, Found = TypeVar("Item"), TypeVar("Found")
AT_ONCE = 16
_ESCAPED: dict[str, str] = {}


def of_each(look: Callable[[Item], Found], items: Iterable[Item]) -> list[Found]:
    """``look(item)`` of each, in order; several at once, since each waits for the file system."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(look), items))


def _opened(spark: SparkSession, path: str):
    # By its whole name: a name taken part by part asks the JVM for every part.
    place = getattr(spark._jvm, "org.apache.hadoop.fs.Path")(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder, not in those below; none if it does not exist."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def tree(spark: SparkSession, path: str) -> list[str]:
    """Files in a folder and all below it, by their path from there; none if it does not exist."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    above = place.toUri().getPath().rstrip("/") + "/"
    found, names = system.listFiles(place, True), []
    while found.hasNext():
        names.append(found.next().getPath().toUri().getPath().removeprefix(above))
    return sorted(names)


def escaped(spark: SparkSession, value: str) -> str:
    """A value as it is spelled in the name of a partition's folder."""
    if value not in _ESCAPED:
        utils = getattr(spark._jvm, "org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils")
        _ESCAPED[value] = utils.escapePathName(value)
    return _ESCAPED[value]


def remove(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)
