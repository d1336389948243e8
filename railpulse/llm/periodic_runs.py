"""Runs of repeated stretches of words, by recompression and candidates on harmonic grids.

A run is a stretch of words with smallest period q, at least ``max(LEAST_WORDS, LEAST_TIMES * q)``
long, that neither neighbour extends. Words are runs of characters other than ASCII white space.

* Candidates: a run with period p is at least four periods long, so a multiple i of p lies in
  its first period, and the words at i, i + p, i + 2p and i + 3p are equal. Looking at all
  multiples of all periods up to a quarter of the longest text takes about n ln n looks.
* A candidate's stretch is exact: how far the words from i on equal those from i + p on, and
  how far those before do, from the grammar of ``recompression``. No suffix arrays, no limit on
  length or period. Stretches found for a multiple of a smaller period are the same stretch.
* A candidate inside a stretch already known, whose period divides p, would give it again and
  is left out; so a text of one word over and over takes no more than its looks.
* Many texts make one sequence with a mark of its own after each; texts with a candidate make
  a shorter one, which is compressed.

Texts are independent rows: nothing is shuffled. Null texts have no words, null ids and
repeated rows are kept, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.llm.recompression import Grammar
from railpulse.llm.tables import whole_text

LEAST_WORDS, LEAST_TIMES = 6, 4
CHUNK_CHARS = 4_000_000
PENDING = 1 << 16  # candidates whose stretches are computed at once, of small periods

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType(), True), T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("collapsed", T.StringType(), False)])


class _Texts:
    """Words of texts as numbers, one text after the other, with a mark of its own after each."""

    def __init__(self, numbers: list[np.ndarray], first_mark: int):
        sizes = np.array([len(n) for n in numbers], np.int64)
        self.begins = np.cumsum(sizes + 1) - (sizes + 1)
        self.sequence = np.empty(int(sizes.sum()) + len(numbers), np.int64)
        self.sequence[self.begins + sizes] = first_mark + np.arange(len(numbers))
        inside = np.ones(len(self.sequence), bool)
        inside[self.begins + sizes] = False
        self.sequence[inside] = np.concatenate([np.zeros(0, np.int64), *numbers])
        self.longest = int(sizes.max(initial=0))

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each period with the places where a run with it may be met."""
        for period in range(1, self.longest // LEAST_TIMES + 1):
            grid = self.sequence[::period]
            equal = grid[1:] == grid[:-1]
            met = np.flatnonzero(equal[:-2] & equal[1:-1] & equal[2:])
            if len(met):
                yield period, met * period


class _Known:
    """Stretches found so far."""

    def __init__(self):
        self.begins = self.ends = self.periods = np.zeros(0, np.int64)

    def add(self, begins: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        begins, ends, periods = (np.concatenate(pair) for pair in (
            (self.begins, begins), (self.ends, ends), (self.periods, periods)))
        order = np.lexsort([periods, ends, begins])
        begins, ends, periods = begins[order], ends[order], periods[order]
        new = np.concatenate([[True], (begins[1:] != begins[:-1]) | (ends[1:] != ends[:-1])])[:len(begins)]
        self.begins, self.ends, self.periods = begins[new], ends[new], periods[new]

    def without_covered(self, period: int, places: np.ndarray) -> np.ndarray:
        """The places that with the one a period on are in no stretch whose period divides it."""
        divides = period % self.periods == 0
        if not divides.any():
            return places
        begins, ends = self.begins[divides], np.maximum.accumulate(self.ends[divides])
        at = np.searchsorted(begins, places, "right") - 1
        return places[(at < 0) | (ends[np.maximum(at, 0)] < places + period + 1)]


def _stretches(texts: _Texts) -> _Known:
    """All runs, as places in the sequence of all texts."""
    grammar, known = Grammar(texts.sequence), _Known()
    waiting: list[tuple[int, np.ndarray]] = []

    def settle() -> None:
        held = [(period, known.without_covered(period, places)) for period, places in waiting]
        waiting.clear()
        periods = np.concatenate([np.full(len(places), period) for period, places in held])
        places = np.concatenate([places for _, places in held])
        for first in range(0, len(places), 1 << 18):
            i, p = places[first:first + (1 << 18)], periods[first:first + (1 << 18)]
            ends = i + p + grammar.forward(i, i + p)
            begins = i - grammar.backward(i, i + p)
            long = ends - begins >= np.maximum(LEAST_WORDS, LEAST_TIMES * p)
            known.add(begins[long], ends[long], p[long])

    bound, held = 1, 0
    for period, places in texts.candidates():
        # Settled at each doubling of the period, so that multiples meet what is known.
        if waiting and (period >= bound or held + len(places) > PENDING):
            settle()
            held = 0
        bound = max(bound, 1 << period.bit_length())
        places = known.without_covered(period, places)
        if len(places):
            waiting.append((period, places))
            held += len(places)
    if waiting:
        settle()
    return known


def runs_of(numbers: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each text, given as numbers of its words: rows of start, length and period,
    by start, then period."""
    none = np.zeros((0, 3), np.int64)
    found = [none] * len(numbers)
    first_mark = 1 + max((int(n.max()) for n in numbers if len(n)), default=0)
    every = _Texts(numbers, first_mark)
    met = np.zeros(len(numbers), bool)
    for _, places in every.candidates():
        met[np.searchsorted(every.begins, places, "right") - 1] = True
    chosen = np.flatnonzero(met)
    if not len(chosen):
        return found
    texts = _Texts([numbers[k] for k in chosen], first_mark)
    known = _stretches(texts)
    of = np.searchsorted(texts.begins, known.begins, "right") - 1
    for k in np.unique(of).tolist():
        own = slice(*np.searchsorted(of, [k, k + 1]).tolist())
        starts = known.begins[own] - texts.begins[k]
        rows = np.stack([starts, known.ends[own] - known.begins[own], known.periods[own]], 1)
        found[chosen[k]] = rows[np.lexsort([rows[:, 2], rows[:, 0]])]
    return found


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when each run is cut down to its first period."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges)[:-1] == 0


def _found(texts: list[str]) -> Iterator[tuple[int, np.ndarray, str]]:
    """Number of words, runs and collapsed text of each text."""
    words = [text.encode().split() for text in texts]  # bytes are split at ASCII white space only
    numbers: dict[bytes, int] = {}
    enter = numbers.setdefault
    spelled = [np.array([enter(w, len(numbers)) for w in own], np.int64) for own in words]
    for own, runs in zip(words, runs_of(spelled)):
        left = own
        if len(runs):
            left = [own[i] for i in np.flatnonzero(kept_words(len(own), runs))]
        yield len(own), runs, b" ".join(left).decode()


def _chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    first, held, size = 0, [], 0
    for k in range(len(column)):
        text = column[k].as_py()
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = k, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def periodic_runs(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start, then period, and ``collapsed``: the words that
    are in no run after its first period, joined by one space."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch["text"], chunk_chars):
                sizes, runs, collapsed = zip(*_found(texts))
                flat = np.concatenate(runs)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
                structs = pa.StructArray.from_arrays(
                    [pa.array(flat[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(texts)), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                     pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(find, FOUND)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """The texts with a periodic tail in one of ten, by the checksum h of the decimal id: there
    every word i from a on becomes word ``a + (i - a) % p``, where ``a = g % n``,
    ``p = 1 + (n - a) // (3 + g % 8)`` and ``g = h // 10``, for n words. Null ids: unchanged."""
    words = F.filter(F.split(whole_text(), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    checksum = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(checksum % 10 == 0, F.lit(False))
    planted = docs.select("doc_id", whole_text().alias("_whole"), chosen.alias("_chosen"),
                          F.floor(checksum / 10).cast("long").alias("_g"),
                          F.when(chosen, words).alias("_words"))
    n, g = F.size("_words").cast("long"), F.col("_g")
    planted = planted.withColumn("_a", F.when(F.col("_chosen") & (n > 0), F.expr("_g % size(_words)")))
    planted = planted.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + g % 8)).cast("long"))
    again = F.transform(F.col("_words"), lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.get(
        F.col("_words"), (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    return planted.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(again, " ")).otherwise(
        F.col("_whole")).alias("text"))
