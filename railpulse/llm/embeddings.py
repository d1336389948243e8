"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

* The model: principal directions of centred unit vectors, and a rotation learned by alternating
  between codes and the rotation that fits them best (Gong & Lazebnik 2011), which evens
  out what the bits carry. It is fitted on at most ``SAMPLE`` vectors, chosen by a hash.
* Every vector gets a code of up to 64 bits. Codes are cut into ``tables`` chunks; a table
  holds each code under the value of its chunk, and is probed with every value within
  ``probe`` bits. Codes that differ in at most ``tables * (probe + 1) - 1`` bits (11 here)
  agree that far in some chunk, so retrieval is exact up to that distance, and likely beyond.
* How many bits differ at a cosine depends on the mean that was taken away: 6.5 of 64 at 0.95
  with a mean of zero, 12 if the mean has 70 % of the energy. So the centred lengths in the sample
  say what share of pairs one rotation retrieves, and as many rotations (``MOST_ROTATIONS`` at
  most) with tables of their own are learned as ``RECALL`` needs.
* Retrieved pairs are reranked by the cosine of the original vectors in double precision, but
  those whose codes differ by more than four standard deviations beyond what a pair at the
  threshold may expect, given the centred length of one of them. A pair is taken from the first
  table that retrieves it.

Equal vectors are one row until links are counted. No number of candidates is capped. Vectors
of different lengths never link; each length has a model of its own, beyond the ``MODELS``
lengths with most vectors in the sample a random rotation. Vectors that are null, zero, or hold
null or non-finite components link with nothing, nor do null ids' rows name a component.
Repeated rows stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from railpulse.llm.components import connected_components
from railpulse.llm.tables import least_hashes, stored
from railpulse.operators.timetable import join_on

SAMPLE, ROUNDS, TABLES, PROBE, COSINE = 20_000, 50, 4, 2, 0.95
RECALL, MOST_ROTATIONS, MODELS = 0.99, 4, 32
BITS = 64


def fit_rotation(vectors: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the matrix that takes centred unit vectors to code scores."""
    dims = vectors.shape[1]
    bits = min(BITS, dims)
    mean = vectors.mean(0) if len(vectors) else np.zeros(dims)
    centred = vectors - mean
    _, directions = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(dims))
    directions = directions[:, ::-1][:, :bits]
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    projected = centred @ directions
    for _ in range(rounds if len(vectors) else 0):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(codes.T @ projected)
        rotation = (u @ v).T
    return mean, directions @ rotation


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, unit``: doubles of length one, null where a vector can't link."""
    values = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (norm > 0)
    return embeddings.select(F.col("vec_id").cast("long"), F.when(
        sound & (norm < float("inf")), F.transform(values, lambda x: x / norm)).alias("unit"))


def of_one_length(units: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and stacked vectors of every length among them."""
    lengths = units.map(len).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.stack([units.iloc[k] for k in at])


def share_of_bits(centred: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """The largest expected share of differing bits of a vector, given its length once the mean is
    gone, and any vector that has at least this cosine with it."""
    apart = math.sqrt(2 - 2 * cosine)
    return np.where(centred > apart, np.arcsin(np.minimum(apart / np.maximum(centred, 1e-12), 1)) / np.pi, 1.0)


def retrieved_share(share: np.ndarray, bits: int, tables: int = TABLES, probe: int = PROBE) -> np.ndarray:
    """The chance that the tables of one rotation retrieve a pair with that share of differing bits."""
    missed = np.ones(len(share))
    edges = chunk_edges(bits, tables)
    for width in np.diff(edges):
        missed *= 1 - sum(math.comb(width, k) * share ** k * (1 - share) ** (width - k)
                          for k in range(min(probe, width) + 1))
    return 1 - missed


def fit_rotations(vectors: np.ndarray, cosine: float = COSINE, tables: int = TABLES,
                  probe: int = PROBE) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean, and as many rotations as it takes to retrieve ``RECALL`` of the pairs at the threshold."""
    mean, first = fit_rotation(vectors)
    missed = 1 - retrieved_share(share_of_bits(np.linalg.norm(vectors - mean, axis=1), cosine),
                                 first.shape[1], tables, probe)
    wanted = next((n for n in range(1, MOST_ROTATIONS) if (missed ** n).mean() <= 1 - RECALL), MOST_ROTATIONS)
    return mean, [first, *[fit_rotation(vectors, seed=5 + n)[1] for n in range(1, wanted)]]


def random_rotation(length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For a length that the sample lacks: no mean, and directions drawn at random."""
    drawn = np.random.default_rng(length).standard_normal((length, min(BITS, length)))
    return np.zeros(length), [np.linalg.qr(drawn)[0]]


def with_codes(units: DataFrame, sample: int = SAMPLE, cosine: float = COSINE, tables: int = TABLES,
               probe: int = PROBE) -> DataFrame:
    """Adds ``size`` (the vector's length), ``codes``, one per rotation, and ``reach``: the number
    of differing bits beyond which no pair at the threshold is expected."""
    chosen = least_hashes(units.select("unit", "first_id"), sample, "unit", "first_id").toPandas()["unit"]
    by_length = sorted((vectors for _, vectors in of_one_length(chosen)), key=len, reverse=True)
    models = {vectors.shape[1]: fit_rotations(vectors, cosine, tables, probe) for vectors in by_length[:MODELS]}

    @F.pandas_udf("codes array<long>, reach int")
    def coded(unit: pd.Series) -> pd.DataFrame:
        codes, reach = np.empty(len(unit), object), np.zeros(len(unit), np.int32)
        for at, vectors in of_one_length(unit):
            mean, rotations = models.get(vectors.shape[1]) or random_rotation(vectors.shape[1])
            centred = vectors - mean
            bits = rotations[0].shape[1]
            powers = np.uint64(1) << np.arange(bits, dtype=np.uint64)
            found = np.stack([((centred @ matrix >= 0) * powers).sum(1, dtype=np.uint64).view(np.int64)
                              for matrix in rotations], 1)
            share = share_of_bits(np.linalg.norm(centred, axis=1), cosine)
            reach[at] = np.minimum(np.ceil(bits * share + 4 * np.sqrt(bits * share * (1 - share))), bits)
            for k, own in zip(at, found):
                codes[k] = own
        return pd.DataFrame({"codes": codes, "reach": reach})

    return units.withColumn("size", F.size("unit")).withColumn("_coded", coded("unit")).select(
        *units.columns, "size", "_coded.codes", "_coded.reach")


def chunk_edges(bits: int, tables: int) -> list[int]:
    return [(2 * bits * t + tables) // (2 * tables) for t in range(tables + 1)]


def candidate_pairs(coded: DataFrame, tables: int = TABLES, probe: int = PROBE) -> DataFrame:
    """``a < b`` of ``group, size, codes, reach`` that multi-index tables retrieve and whose codes
    differ within the reach of ``b``, each pair once."""
    bits = f"least(size, {BITS})"

    def edge(t: int) -> str:
        return f"((2 * {bits} * {t} + {tables}) div {2 * tables})"

    def chunk(code: str, t: int) -> str:
        width = f"cast({edge(t + 1)} - {edge(t)} as int)"
        # A chunk of all 64 bits has no mask below the sign.
        inside = f"if({width} > 63, -1L, shiftleft(1L, {width}) - 1)"
        return f"(shiftrightunsigned({code}, cast({edge(t)} as int)) & {inside})"

    def flips(width: int) -> list[int]:
        """All masks of at most ``probe`` bits."""
        found = {0}
        for _ in range(probe):
            found |= {mask | 1 << bit for mask in found for bit in range(width)}
        return sorted(found)

    # The number of a table names the vectors' length and the rotation too: only equals meet.
    per_code = coded.select("group", "size", "reach", F.posexplode("codes").alias("rotation", "code"))
    number = f"size * {MOST_ROTATIONS * tables}L + rotation * {tables}"
    kept = per_code.select(
        F.col("group").alias("b"), F.col("code").alias("b_code"), F.col("reach"), F.inline(F.array(*[
            F.struct(F.expr(f"{number} + {t}").alias("tab"), F.expr(chunk("code", t)).alias("val"))
            for t in range(tables)])))
    widest = max(b - a for a, b in zip(chunk_edges(BITS, tables), chunk_edges(BITS, tables)[1:]))
    masks = F.array(*[F.lit(m).cast("long") for m in flips(widest)])
    asked = per_code.select(
        F.col("group").alias("a"), F.col("code").alias("a_code"), F.inline(F.array(*[
            F.struct(F.expr(f"{number} + {t}").alias("tab"), F.expr(chunk("code", t)).alias("own"),
                     F.expr(f"cast({edge(t + 1)} - {edge(t)} as int)").alias("width"))
            for t in range(tables)]))).select(
                "a", "a_code", "tab", "own", F.explode(F.when(
                    F.col("width") >= widest, masks).otherwise(F.filter(
                        masks, lambda m: F.shiftrightunsigned(m, 0) < F.expr("shiftleft(1L, width)")))).alias("mask")
            ).select("a", "a_code", "tab", F.col("own").bitwiseXOR(F.col("mask")).alias("val"))
    size = f"(tab div {MOST_ROTATIONS * tables})"
    # How many leading tables of the rotation miss the pair: it is taken from the one after those.
    first = F.lit(True)
    for t in range(tables - 1):
        missed = F.bit_count(F.expr(chunk("(a_code ^ b_code)", t).replace("size", size))) > probe
        first = first & ((F.col("tab") % tables <= t) | missed)
    near = F.bit_count(F.expr("a_code ^ b_code")) <= F.col("reach")
    # Never a broadcast: probes outgrow by far what their table's size makes the planner expect.
    met = asked.hint("merge").join(kept, ["tab", "val"]).where((F.col("a") < F.col("b")) & near & first)
    # Several rotations may retrieve a pair.
    return met.select("a", "b").distinct()


def links(groups: DataFrame, pairs: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The pairs whose original vectors have at least this cosine."""
    one = groups.select(F.col("group").alias("a"), F.col("unit").alias("a_unit"), F.col("copies").alias("a_copies"))
    two = groups.select(F.col("group").alias("b"), F.col("unit").alias("b_unit"), F.col("copies").alias("b_copies"))

    @F.pandas_udf("double")
    def product(a: pd.Series, b: pd.Series) -> pd.Series:
        cosines = np.zeros(len(a))
        for at, vectors in of_one_length(a):
            cosines[at] = np.einsum("ij,ij->i", vectors, np.stack([b.iloc[k] for k in at]))
        return pd.Series(cosines)

    met = join_on(join_on(pairs, one, ["a"], how="inner"), two, ["b"], how="inner")
    return met.where(product("a_unit", "b_unit") >= cosine).select("a", "b", "a_copies", "b_copies")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, sample: int = SAMPLE,
                    tables: int = TABLES, probe: int = PROBE) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row per row of ``embeddings``."""
    units = unit_vectors(embeddings)
    # A copy of a vector is found by a digest of its components; -0.0 counts as 0.0.
    digest = F.sha2(F.array_join(F.transform("unit", lambda x: (x + 0.0).cast("string")), ","), 256)
    rows = stored(units.select("vec_id", "unit", F.when(F.col("unit").isNotNull(), digest).alias("digest")),
                  "units")
    sound = rows.where("digest is not null")
    groups = sound.groupBy("digest").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    units_of = sound.groupBy("digest").agg(F.first("unit").alias("unit"))
    # Numbered once and stored: no two vectors share a number, as two hashes might.
    groups = stored(join_on(groups, units_of, ["digest"], how="inner").withColumn(
        "group", F.monotonically_increasing_id()), "groups")
    coded = stored(with_codes(groups, sample, cosine, tables, probe), "codes")
    pairs = candidate_pairs(coded.select("group", "size", "codes", "reach"), tables, probe)
    found = stored(links(coded, pairs, cosine), "links")
    both = found.select(F.col("a").alias("group"), F.col("b_copies").alias("n")).unionAll(
        found.select(F.col("b").alias("group"), F.col("a_copies").alias("n")))
    degrees = both.groupBy("group").agg(F.sum("n").alias("others"))
    linked = connected_components(found).withColumnRenamed("node", "group")
    named = join_on(join_on(coded.select("digest", "group", "copies", "first_id"), degrees, ["group"]),
                    linked, ["group"]).withColumn("component", F.coalesce("component", "group"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = join_on(named, names, ["component"]).select(
        "digest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    found = join_on(sound.select("vec_id", "digest"), named, ["digest"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("vec_id").alias("component_id"))
    return found.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
