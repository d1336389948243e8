"""Document fingerprints: a homomorphic multiset hash of paragraphs, in built-in functions only.

Every paragraph (a line that is not blank) is hashed into a wide vector, and a text's
fingerprint is the sum of its paragraphs' vectors, lane by lane modulo 2**32. So the order
of paragraphs does not matter, and adding or removing one adds or subtracts its vector
(``plus`` and ``minus``) without reading the rest. The lanes of a paragraph are

* ``2 * SEEDS`` lanes of its own hash under several seeds: any difference changes them all,
  which makes equality of fingerprints equality of the multisets;
* 64 lanes that count, bit by bit, how many of its shingles' hashes have that bit set, and
  one lane with their number: centred, these are sums of random signs, whose cosine is that
  of the multisets of shingles. That is the likeness of two fingerprints.

Null and empty texts have the zero fingerprint. Fingerprints are alike to 1 if equal, to 0
if one only is zero. Rows that share an id are kept, ordered by text. Rows with a null id
have no place in the order of ids: nothing comes next to them. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.window import Window

from railpulse.llm.tables import whole_text

SEEDS, SHINGLE = 8, 3
LANE = 0xFFFFFFFF
PAIR = 0x0000000100000001  # the lowest bit of both halves of a long


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda p: F.trim(p) != "")


def paragraph_units(paragraph: Column, words: Column) -> Column:
    """Hashes of a paragraph with their seed, and of its shingles with seed -1."""
    whole = [F.struct(F.xxhash64(F.lit(j), paragraph).alias("h"), F.lit(j).alias("seed")) for j in range(SEEDS)]
    shingle = lambda i: F.struct(
        F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]).alias("h"), F.lit(-1).alias("seed"))
    # A paragraph of fewer words is one shingle.
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.concat(F.array(*whole), F.transform(F.sequence(F.lit(0), last), shingle))


def summed_lanes(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``lanes`` of the text of each row; the keys must tell rows apart."""
    pieces = (texts.select(*keys, F.explode_outer(paragraphs(F.col(text))).alias("_paragraph"))
              .withColumn("_words", F.split(F.trim("_paragraph"), r"\s+")))
    units = pieces.select(*keys, F.inline_outer(F.when(
        F.col("_paragraph").isNotNull(), paragraph_units(F.col("_paragraph"), F.col("_words")))))
    is_shingle = F.coalesce(F.col("seed") < 0, F.lit(False))
    # Two lanes are counted at once: the bits s and s + 32 of a hash.
    counts = [F.sum(F.when(is_shingle, F.shiftrightunsigned("h", s).bitwiseAND(F.lit(PAIR)))
                    .otherwise(F.lit(0).cast("long"))).alias(f"_c{s}") for s in range(32)]
    own = [F.sum(F.when(F.col("seed") == j, part).otherwise(F.lit(0).cast("long"))).alias(f"_{half}{j}")
           for j in range(SEEDS)
           for half, part in (("l", F.col("h").bitwiseAND(F.lit(LANE))), ("h", F.shiftrightunsigned("h", 32)))]
    number = F.sum(F.when(is_shingle, 1).otherwise(0).cast("long")).alias("_n")
    totals = units.groupBy(*keys).agg(*own, number, *counts)
    low = lambda c: F.col(c).bitwiseAND(F.lit(LANE))
    lanes = [*[low(f"_{half}{j}") for j in range(SEEDS) for half in "lh"], low("_n"),
             *[low(f"_c{s}") for s in range(32)],
             *[F.shiftrightunsigned(f"_c{s}", 32).bitwiseAND(F.lit(LANE)) for s in range(32)]]
    return totals.select(*keys, F.array(*lanes).alias("lanes"))


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(LANE)))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of what is left of ``a`` without the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(LANE)))


def as_hex(lanes: Column) -> Column:
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the multisets of shingles as estimated from the lanes, 0 to 1."""
    first = 2 * SEEDS
    signs = lambda lanes: F.transform(
        F.slice(lanes, first + 2, 64), lambda x: (2 * x - F.get(lanes, F.lit(first))).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    norm = F.sqrt(dot(signs(a), signs(a)) * dot(signs(b), signs(b)))
    cosine = F.when(norm > 0, dot(signs(a), signs(b)) / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Lanes of every text, where ``keys`` tell the rows apart."""
    return summed_lanes(docs.select(*keys, whole_text().alias("text")), keys)


# --- a document, its edited text and the next document --------------------------------

def _bisected(splits: list[int], value: Column) -> Column:
    """How many of the sorted splits a value has reached, by halving."""
    if not splits:
        return F.lit(0)
    table, steps = F.array(*map(F.lit, splits)), []
    step = 1 << (len(splits).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        (at + step <= len(splits)) & (F.get(table, at + step - 1) <= value), at + step).otherwise(at))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, place, doc_id, text, next_text`` in ascending ids, the last one's next being the first.

    Ids are cut into buckets of about equally many rows, and each bucket ends with a copy of
    the first row of the following one (``doc_id`` null, ``borrowed``). A bucket is the only
    thing that is ordered in one task.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 100 * buckets)).first()[0] if shares else None
    splits = sorted(set(found or []))
    # Ids that are null are spread by their text, in buckets of their own.
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(buckets)).cast("int")
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), spread).otherwise(
        _bisected(splits, F.col("doc_id"))))
    ring = Window.orderBy("bucket")  # over a row per bucket
    firsts = rows.where("bucket >= 0").groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    last_bucket = F.max("bucket").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("bucket", "first_id", F.coalesce(F.lag("bucket").over(ring), last_bucket).alias("to"))
    borrowed = (rows.join(F.broadcast(firsts), "bucket").where("doc_id = first_id")
                .groupBy("to").agg(F.min("text").alias("text"))
                .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("to").alias("bucket"),
                        F.lit(True).alias("borrowed")))
    whole = rows.withColumn("borrowed", F.lit(False)).unionByName(borrowed)
    order = Window.partitionBy("bucket").orderBy("borrowed", "doc_id", "text")
    return whole.select("bucket", F.row_number().over(order).alias("place"), "doc_id", "text", "borrowed",
                        F.when(F.col("bucket") >= 0, F.lead("text").over(order)).alias("next_text"))


def edit_likeness(docs: DataFrame, buckets: int) -> DataFrame:
    """Fingerprints of each text and its edited text, and the likeness to that and to the next.

    The edited text has, instead of the last quarter of the code points, as many of the next
    document's first (or all it has).
    """
    rows = with_next(docs, buckets).withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter))
    rows = rows.select("bucket", "place", "borrowed", "doc_id", "n_chars", "text", edited.alias("edited"))
    versions = rows.select("bucket", "place", "borrowed", "doc_id", "n_chars", F.inline(F.filter(F.array(
        F.struct(F.lit(0).alias("version"), F.col("text"), F.lit(None).cast("string").alias("sha")),
        F.struct(F.lit(1).alias("version"), F.col("edited").alias("text"), F.sha2("edited", 256).alias("sha"))),
        lambda v: ~F.col("borrowed") | (v["version"] == 0))))
    keys = ["bucket", "place", "version", "borrowed", "doc_id", "n_chars", "sha"]
    lanes = summed_lanes(versions, keys)
    # In the order of places a text is followed by its edited text and by the next text.
    order = Window.partitionBy("bucket").orderBy("place", "version")
    beside = lanes.withColumns({"edited_lanes": F.lead("lanes").over(order),
                                "edited_sha256": F.lead("sha").over(order),
                                "next_lanes": F.lead("lanes", 2).over(order)})
    return beside.where("version = 0 and not borrowed").select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("lanes")).alias("fingerprint"),
        as_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        F.when(F.col("bucket") < 0, 0.0).otherwise(likeness(F.col("lanes"), F.col("next_lanes"))).alias("near_next"))
