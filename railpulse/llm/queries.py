"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.llm import (
    bpe,
    byte_bpe,
    collocations,
    embeddings,
    fingerprints,
    langid,
    packing,
    periodic_runs,
    sharding,
    simhash,
    token_files,
    toxicity,
    warc,
)
from railpulse.llm.tables import read, stored
from railpulse.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_hilbert_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(read(spark, sf, "documents"), tokenizer(), end_id=1, length=2048).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset", "curve_key")


@query
def op2_multiset_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fingerprints.edit_likeness(read(spark, sf, "documents"), buckets)


@query
def op4_warc_salvage(spark: SparkSession, sf: str) -> DataFrame:
    typed = warc.with_record_types(read(spark, sf, "pages"))
    archives = warc.write_archives(typed, shared_folder(spark, "warc"))
    drilled = warc.salvage_drill(archives, shared_folder(spark, "warc-damaged")).agg(F.sum("lost_unstruck")).first()
    if drilled[0]:
        raise ValueError(f"salvage lost {drilled[0]} records of damaged copies that the damage did not strike")
    found = stored(warc.read_archives(archives).drop("payload"), "warc-read")
    return warc.split_read(found, archives, shared_folder(spark, "warc-quarantine")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op4_warc_salvage"] = """
with rows as (select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) payload_bytes,
                     sha256(coalesce(html, '')) payload_digest from pages),
     firsts as (select payload_digest, min(page_id) first_id from rows where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
       case when first_id is null or page_id = first_id then 'response' else 'revisit' end record_type,
       case when page_id <> first_id then first_id end refers_to
from rows left join firsts using (payload_digest)
"""


@query
def op5_hilbert_shards(spark: SparkSession, sf: str) -> DataFrame:
    indexed = sharding.with_curve_index(read(spark, sf, "documents"))
    return sharding.with_shards(indexed, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index")


@query
def op7_pair_index_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ids = bpe.encoded(read(spark, sf, "documents"), tokenizer())
    return bpe.decoded(ids, tokenizer()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"))


@query
def op8_itq_neardup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf, "embeddings"))


ORACLE_SQL["op8_itq_neardup"] = """
with recursive v as (select vec_id, cast(embedding as double[]) e from embeddings),
     l as (select a.vec_id a, b.vec_id b from v a join v b on a.vec_id <> b.vec_id
           where list_cosine_similarity(a.e, b.e) >= 0.95),
     r(vec_id, reached) as (select vec_id, vec_id from v
                            union select r.vec_id, l.b from r join l on r.reached = l.a)
select vec_id, (select count(*) from l where a = r.vec_id) n_links, min(reached) component_id,
       vec_id = min(reached) kept
from r group by vec_id
"""


@query
def op9_simhash_pivots(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf, "documents"), shingle=4, seed=42, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_seekable_tokens(spark: SparkSession, sf: str) -> DataFrame:
    manifest = token_files.write_token_files(
        read(spark, sf, "documents"), shared_folder(spark, "tokens"), tokenizer(), end_id=0)
    return token_files.read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def remainder(divisor: int):
    """crc32 of the id as text, modulo a number; null for null ids."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


@query
def op3_weak_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    found = toxicity.toxicity_scores(
        read(spark, sf, "documents"), read(spark, sf, "labels"), may_learn=remainder(3) != 1)
    return found.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op6_hyperdimensional_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    prototypes = langid.learned(docs, may_learn=remainder(4) != 2)
    return langid.predicted(docs, prototypes).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op13_scanned_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = byte_bpe.decoded(byte_bpe.encoded(read(spark, sf, "documents"), ranks), ranks)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"))


@query
def op11_recompression_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = periodic_runs.with_planted_repeats(read(spark, sf, "documents"))
    runs = F.col("runs")
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                   r["period"].cast("string")))
    # Lengths and periods are exact integers far below 2^31, so cross products fit a long.
    best = F.aggregate(runs, F.get(runs, F.lit(0)), lambda top, r: F.when(
        r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top))
    return periodic_runs.periodic_runs(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start"), F.col("best.length"), F.col("best.period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_counted_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(read(spark, sf, "documents"))


ORACLE_SQL["op12_counted_collocations"] = r"""
with pieces as (select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
                from documents),
     lists as (select lang, [x for x in string_split_regex(piece, '[ \t]+') if x <> ''] w from pieces),
     grams as (select lang, k, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) w
               from lists, range(1, 6) t(k) where len(w) >= k),
     counts as (select lang, k, w, count(*) f from grams group by 1, 2, 3),
     totals as (select lang, sum(f) n from counts where k = 1 group by 1),
     kept as (select * from counts where f >= 100),
     cuts as (select c.lang, c.w, c.f a, j, l.f l, r.f r, n,
                  1000::hugeint * c.f::hugeint * n::hugeint // (l.f::hugeint * r.f::hugeint) score
              from (select *, unnest(range(1, k)) j from kept where k > 1) c
              join kept l on l.lang = c.lang and l.w = c.w[1:j]
              join kept r on r.lang = c.lang and r.w = c.w[j + 1:]
              join totals t on t.lang = c.lang),
     weakest as (select * from cuts qualify row_number() over (partition by lang, w order by score, j) = 1),
     around as (select lang, w[i:i + s - 1] w, max(f) f
                from (select lang, w, f, s, unnest(range(1, k - s + 2)) i
                      from (select *, unnest(range(2, k)) s from kept where k > 2)) group by 1, 2),
     ranked as (select c.lang, array_to_string(c.w, ' ') phrase, a, l, r, n, score
                from weakest c left join around i on i.lang = c.lang and i.w = c.w
                where i.f is null or i.f < a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
       a::bigint a, l::bigint l, r::bigint r, n::bigint n, score::bigint score
from ranked qualify rank <= 2000
"""
