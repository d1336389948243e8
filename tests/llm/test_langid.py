import zlib

from pyspark.sql import functions as F

from railpulse.llm import langid
from tests.llm import cases


def not_held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 != 2


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = langid.predicted(docs, langid.learned(docs, not_held_out()), ("doc_id", "lang")).collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(found) == docs.count()
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.99 * len(held)


def test_held_out_rows_are_not_learned(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    turned = docs.withColumn("lang", F.when(not_held_out(), F.col("lang")).otherwise("xx"))
    one, two = (langid.learned(table, not_held_out()) for table in (docs, turned))
    assert one[0] == two[0] and abs(one[1] - two[1]).max() < 1e-5


def test_unusual_rows(spark):
    docs = cases.unusual(spark, clashing=True)
    prototypes = langid.learned(docs, F.col("doc_id").isNotNull())
    assert prototypes[0] == ["de", "en", "ja"]
    rows = langid.predicted(docs, prototypes).collect()
    assert len(rows) == len(cases.ROWS)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    for doc_id in (2, 3, 9):
        assert found[doc_id] == ("und", 0.0)
    assert [found[k][0] for k in (1, 5, 6, 7)] == ["en", "de", "en", "ja"]
    assert all(0 <= s <= 1 for _, s in found.values())


def test_nothing_to_learn_and_nothing_to_do(spark):
    nothing = langid.learned(cases.empty(spark), F.lit(True))
    assert {r["lang_pred"] for r in langid.predicted(cases.unusual(spark), nothing).collect()} == {"und"}
    assert langid.predicted(cases.empty(spark), nothing).count() == 0


def test_long_words_of_one_letter():
    vectors, counts = langid.run_counts(["", "a", "ab cd", "aaaa"])
    assert counts.sum(1).tolist() == [0, 1, 4, 4] and vectors.shape[1] == langid.DIMS
