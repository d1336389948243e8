"""Connected components of links, by alternating large-star and small-star rounds.

Each round is a join and two aggregations over the links that are left; no node's links
meet in one task unsplit and none come to the driver. Links shrink towards one star per
component, in a number of rounds that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm.tables import stored
from railpulse.operators.timetable import join_on


def _with_least(pairs: DataFrame) -> DataFrame:
    """``(node, other)`` rows with ``least``, the smallest of a node and its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return join_on(pairs, least, ["node"], how="inner").withColumn(
        "least", F.least("node", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("node", "other").unionAll(
        links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return (_with_least(both).where("other > node")
            .select(F.col("other").alias("node"), F.col("least").alias("other")))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` have ``other < node``."""
    joined = _with_least(links)
    moved = joined.where("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
    kept = joined.select("node", F.col("least").alias("other"))
    return moved.unionAll(kept)


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Columns ``node`` and ``component`` (its smallest node), for every node with a link.

    Links may be repeated and in either direction; links to oneself or null are ignored.
    """
    one, two = F.col(left).cast("long"), F.col(right).cast("long")
    current = stored(
        links.select(F.greatest(one, two).alias("node"), F.least(one, two).alias("other"))
        .where(one.isNotNull() & two.isNotNull() & (one != two)).distinct(), "links")
    before = _state(current)
    while before[0]:
        larger = stored(_large_star(current).distinct(), "links")
        current = stored(_small_star(larger).distinct(), "links")
        now = _state(current)
        if now == before:
            break
        before = now
    tops = current.select(F.col("other").alias("node")).distinct()
    return current.select("node", F.col("other").alias("component")).unionAll(
        tops.select("node", F.col("node").alias("component")))
