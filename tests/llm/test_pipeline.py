import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from railpulse.llm import simhash
from railpulse.llm.tables import stored
from tests.llm import cases


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of each stage over a whole table, by the path that ``run`` takes."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], sf_dir), "test"))
    return found


def test_columns_and_shrinking(stages):
    columns = list(corpus_pipeline.COLUMNS)
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == columns
        assert after.count() < before.count() or after.count() == before.count()
        assert after.exceptAll(before).count() == 0
    assert "sequence_id" in stages[-1].columns


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
              if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    kept = {r["doc_id"] for r in stages[1].select("doc_id").collect()}
    toxic = [k not in kept for k, t in labels.items() if t]
    clean = [k not in kept for k, t in labels.items() if not t]
    assert sum(toxic) > 0.85 * len(toxic) and sum(clean) < 0.01 * len(clean)


def test_only_texts_without_letters_have_no_language(stages):
    gone = stages[1].join(stages[2], "doc_id", "left_anti")
    assert all(not any(c.isalpha() for c in r["text"]) for r in gone.collect())


def test_one_of_each_group_stays(stages):
    component = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(stages[2]).collect()}
    kept = {r["doc_id"] for r in stages[3].select("doc_id").collect()}
    same_text = {}
    for r in stages[2].collect():
        same_text.setdefault(r["text"], []).append(r["doc_id"])
        component.setdefault(r["doc_id"], None)
    for ids in same_text.values():
        assert len(kept.intersection(ids)) <= 1
        for k in ids:  # what goes leaves the first of its group
            if k not in kept and k == min(ids):
                assert component[k] in kept and component[k] < k


def test_everything_that_stays_is_packed(stages):
    whole = stages[4].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert whole.where("n <> all").count() == 0
    assert whole.count() == stages[3].count()


def test_unusual_rows_in_every_stage(spark, sf001):
    for docs in (cases.unusual(spark, clashing=True), cases.empty(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf001)
            assert out.columns == list(corpus_pipeline.COLUMNS), name
            assert out.count() <= n
        assert corpus_pipeline.pack(spark, docs, sf001).select("doc_id").distinct().count() == min(n, len(
            {r[0] for r in cases.ROWS}))
