"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIMS`` signs. A run of three letters (or word edges)
is bound into one vector by permuting (cyclic shift) and multiplying the letters' vectors;
a text's profile bundles (adds) the vectors of all its runs, and a language's prototype
those of all texts it may learn from. The prediction is the language whose prototype has
the largest cosine with the text's profile.

Bundling is linear, so tasks add up counts of runs before they build vectors; what they send
is one vector per language and task. Word edges are any characters that are no letters;
letters are lowered.

Null texts and texts without letters get the language ``und`` and score 0, as does
everything if there is nothing to learn from. Rows with a null id are never learned from.
Repeated rows count and are returned as often as they are there. Equal cosines go to the
language first in the alphabet. Columns other than id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from railpulse.llm.tables import whole_text

DIMS, SYMBOLS, SEED = 1024, 2048, 11
BATCH_CHARS, BATCH_TEXTS = 500_000, 400
UNKNOWN = "und"
Prototypes = tuple[list[str], np.ndarray]


@lru_cache(maxsize=1)
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs per symbol for the first, second and third place of a run."""
    signs = (np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMS)) * 2 - 1).astype(np.int8)
    return np.roll(signs, 2, 1), np.roll(signs, 1, 1), signs


@lru_cache(maxsize=1)
def symbol_of() -> np.ndarray:
    """Symbol per code point: 0 for an edge, letters by their number (from 1024 on, modulo 1024)."""
    points = np.arange(0x110000)
    letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.where(points < 1024, points, 1024 + points % 1024), 0).astype(np.int16)


def run_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vector of every different run in the texts, and a row of counts of them per text."""
    points = [np.frombuffer(text.lower().encode("utf-32-le"), "<u4") for text in texts]
    symbols = np.concatenate([part for p in points for part in (np.zeros(1, np.int16), symbol_of()[p])]
                             + [np.zeros(1, np.int16)])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) + 1 for p in points])
    owner = np.append(owner, owner[-1:])
    kept = np.ones(len(symbols), bool)
    kept[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)  # one edge between words
    symbols, owner = symbols[kept], owner[kept]
    present = np.flatnonzero(np.bincount(symbols, minlength=1))
    base = len(present)
    dense = np.zeros(SYMBOLS, np.int32 if base ** 3 < 1 << 31 else np.int64)
    dense[present] = np.arange(base)
    dense = dense[symbols]
    runs = (dense[:-2] * base + dense[1:-1]) * base + dense[2:]
    lettered = (symbols[1:-1] != 0)
    runs, owner = runs[lettered], owner[1:-1][lettered]
    if base ** 3 <= 1 << 22:
        found = np.flatnonzero(np.bincount(runs, minlength=base ** 3))
        place = np.zeros(base ** 3, np.int64)
        place[found] = np.arange(len(found))
        number = place[runs]
    else:
        found, number = np.unique(runs, return_inverse=True)
    counts = np.bincount(owner * max(len(found), 1) + number, minlength=len(texts) * len(found)).reshape(
        len(texts), len(found)).astype(np.float32)
    first, second, third = letter_vectors()
    at = present[found // (base * base)], present[found // base % base], present[found % base]
    return (first[at[0]] * second[at[1]] * third[at[2]]).astype(np.float32), counts


def profiles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vector of every text, and how many runs it has."""
    vectors, counts = run_counts(texts)
    return counts @ vectors, counts.sum(1)


def text_groups(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of at most so many texts with about ``limit`` characters."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if k > first and (size + len(text) > limit or k - first >= BATCH_TEXTS):
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def learned(docs: DataFrame, may_learn: Column) -> Prototypes:
    """Prototypes of unit length; a row per language and task comes to the driver summed."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
            for first, last in text_groups(texts):
                vectors, counts = run_counts(texts[first:last])
                for lang in set(langs[first:last]):
                    own = np.array([x == lang for x in langs[first:last]])
                    totals[lang] = totals.get(lang, 0) + (counts[own].sum(0, dtype=np.float64) @ vectors)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * DIMS), "dim": pa.array(range(DIMS), pa.int32()), "total": total})

    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string"), whole_text().alias("text"))
    summed = (rows.mapInArrow(bundle, "lang string, dim int, total double")
              .groupBy("lang", "dim").agg(F.sum("total").alias("total"))
              .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dim", "total"))).alias("vector")))
    # DIMS numbers per language.
    found = sorted((row["lang"], [x["total"] for x in row["vector"]]) for row in summed.collect())
    found = [(lang, np.array(vector)) for lang, vector in found if np.any(vector)]
    unit = np.stack([v / np.linalg.norm(v) for _, v in found]) if found else np.zeros((0, DIMS))
    return [lang for lang, _ in found], unit.astype(np.float32)


def predicted(docs: DataFrame, prototypes: Prototypes, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carried`` columns with ``lang_pred`` and ``score``, the cosine (0 if negative)."""
    langs, unit = prototypes

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["_whole"].to_pylist()
            for first, last in text_groups(texts):
                profile, runs = profiles(texts[first:last])
                cosines = profile @ unit.T / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-9)
                known = (runs > 0) & bool(langs)
                best = cosines.argmax(1) if langs else np.zeros(last - first, int)
                score = np.clip(cosines.max(1), 0, 1) if langs else np.zeros(last - first)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in carried]
                    + [pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                       pa.array(np.where(known, score, 0.0).astype(float))],
                    [*carried, "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), "lang_pred string", "score double"])
    return docs.select(*carried, whole_text().alias("_whole")).mapInArrow(predict, schema)
