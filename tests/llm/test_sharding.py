import zlib
from collections import Counter

from pyspark.sql import functions as F

from railpulse.llm import sharding
from railpulse.session import shared_folder
from tests.llm import cases


def test_even_counts_and_slots(spark):
    for docs in (cases.unusual(spark, clashing=True), cases.unusual(spark).drop("lang", "source")):
        rows = sharding.with_shards(sharding.with_curve_index(docs), 4).collect()
        assert len(rows) == len(cases.ROWS)
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots.get(s, [])) for s in range(4)]
        assert sum(sizes) == len(cases.ROWS) and max(sizes) - min(sizes) <= 1
        want = sorted((str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode()))
                      for r in cases.ROWS)
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want


def test_fewer_rows_than_shards(spark):
    rows = sharding.with_shards(sharding.with_curve_index(cases.unusual(spark)), 24).collect()
    assert len({r["shard"] for r in rows}) == len(cases.ROWS) and {r["slot"] for r in rows} == {0}


def test_null_and_repeated_ids_are_written(spark):
    docs = cases.unusual(spark, clashing=True)
    docs = docs.unionAll(docs)
    path = shared_folder(spark, "shards")
    sharding.write_shards(docs.withColumn("slot", F.lit("x")), path, 4)
    rows = spark.read.parquet(path).select("doc_id", "text", "shard", "slot").collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(
        (r["doc_id"], r["text"]) for r in docs.collect())
    assert len({(r["shard"], r["slot"]) for r in rows}) == 2 * len(cases.ROWS)


def test_empty_table(spark):
    assert sharding.with_shards(sharding.with_curve_index(cases.empty(spark)), 24).count() == 0


def test_shards_are_compact_and_written(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    path = shared_folder(spark, "shards")
    sharding.write_shards(docs, path, 24)
    stored = spark.read.parquet(path)
    assert stored.count() == docs.count()
    rows = stored.select("shard", "lang", "source", "n_chars").collect()
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r)
    assert len(shards) == 24
    # A filter on language or source finds its rows in few of the shards.
    assert sum(len({r["lang"] for r in own}) for own in shards.values()) / 24 < 3
    assert sum(len({r["source"] for r in own}) for own in shards.values()) / 24 < 10
