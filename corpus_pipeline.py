"""Pipeline over ``documents``: toxicity, language, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All
but the last return the columns of ``documents``; the last returns the packed pieces.
``run`` writes each stage's rows as Parquet to the shared folder and reads them back for
the next, so that a lost executor costs no more than the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.llm import langid, packing, simhash, toxicity
from railpulse.llm.queries import remainder, tokenizer
from railpulse.llm.tables import read, stored

TOXIC_FROM = 0.7
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the model learns from the labels of rows not held out."""
    scores = toxicity.toxicity_scores(docs, read(spark, sf_dir, "labels"), may_learn=remainder(3) != 1)
    # The score is a function of the id and its text; an id that is there twice goes if one is toxic.
    rejected = scores.where(F.col("score") >= TOXIC_FROM).select("doc_id").distinct()
    # What is rejected grows with the documents, so it is never broadcast.
    return docs.select(*COLUMNS).join(rejected.hint("merge"), "doc_id", "left_anti").select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without any letter go."""
    prototypes = langid.learned(docs, may_learn=remainder(4) != 2)
    found = langid.predicted(docs.withColumn("_text", F.col("text")), prototypes, carried=COLUMNS)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity 0.8."""
    return simhash.first_of_each(docs.select(*COLUMNS), shingle=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids along the curve."""
    return packing.packed(docs, tokenizer(), end_id=1, length=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_duplicates", keep_first_copies),
    ("packing", pack),
]

#: SQL has neither the trained models nor the hash of the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
