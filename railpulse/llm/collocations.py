"""Phrase collocations by dynamic itemset counting over cyclic scans of shards.

The words of all texts are stored once, as numbers, in ``shards`` shards, which are scanned one a
step, round and round. Steps of the first cycle count words. As soon as both phrases that a longer
one consists of (all its words but the last, all but the first) have been counted ``least`` times,
the longer one is counted too, from the next step on and for one full cycle; so lengths are counted
side by side in the same scans, and scanning ends when no phrase is active any more. That takes
two to five cycles for phrases of five words.

* Which phrases have reached ``least``, and in which step, tasks see in a table of at most
  ``MAX_SLOTS`` bytes, by a hash of the phrase. Phrases that share a slot are only counted for
  nothing or too early: a phrase's count in a shard is the same whenever it is taken, and is kept
  by shard, so no count is wrong and none is added twice. With far more frequent phrases than
  slots more is counted for nothing; the table never grows beyond its bound.
* Words are 64-bit hashes, seeded by the language, so that a phrase tells its language. All words
  are grouped by hash first; if two share one, everything is hashed anew with another seed.
  Phrases are the hashes of their words side by side, not a hash of a hash.
* Counts are summed in each task, then by shuffle together with those of the steps before.
  Phrases whose cycle is over and that have fewer than ``least`` are dropped.
* What a task holds does not grow with the table: numbers are stored in rows of ``ROW_TOKENS`` and row
  groups of ``GROUP_BYTES``, a task of a step reads ``SCAN_BYTES`` of them or of counts at most, and what
  goes to Python and back are batches of a few MB.

Texts have A-Z lowered, are cut into pieces at ``.,;:!?`` and line ends and these into words at
spaces and tabs. Phrases don't cross pieces. Everything is by language; null is ``und``. Null texts
have no words. Repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railpulse.llm.tables import stored, whole_text
from railpulse.operators.timetable import join_on
from railpulse.session import shared_folder

LEAST, LONGEST, SHARDS, TOP = 100, 5, 2, 2000
FIRST_SLOTS, MAX_SLOTS, SLOTS_PER_PHRASE = 1 << 10, 1 << 24, 32  # powers of two
ROW_TOKENS = 1 << 12  # numbers in a stored row; a page has 100 rows at least
BATCH_TOKENS = 1 << 16  # numbers of the rows that are written at once
GROUP_BYTES, SCAN_BYTES = 1 << 23, 1 << 23  # of a stored row group, and what a task of a step reads
SCAN_TOKENS = 1 << 19  # numbers whose phrases a task sums at once
SALTS = 64
UNKNOWN = "und"
DICTIONARY = -1

# Characters that end a piece, and those between words.
PIECE_ENDS, BETWEEN = b".,;:!?\n\x0b\x0c\r", b" \t"
_FROM = bytes(range(ord("A"), ord("Z") + 1)) + PIECE_ENDS + BETWEEN
_TO = bytes(range(ord("a"), ord("z") + 1)) + b"\n" * len(PIECE_ENDS) + b" " * len(BETWEEN)
TRANSLATED = bytes.maketrans(_FROM, _TO)
PIECE_END, NO_WORD = 0, 1  # numbers that are no words


class _Numbers(dict):
    """Number of each word of a language: its hash."""

    def __init__(self, lang: str, seed: int):
        super().__init__({b"\n": PIECE_END, b"": NO_WORD})
        self.seed = xxhash.xxh64_intdigest(lang, seed)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = max(2, xxhash.xxh64_intdigest(word, self.seed))
        return number

    def entries(self, first: int) -> tuple[list[bytes], list[str]]:
        entries = list(self.items())[first:]
        return [n.to_bytes(8, "little") for _, n in entries], [w.decode() for w, _ in entries]


def word_numbers(text: str, numbers: dict[bytes, int]) -> np.ndarray:
    """Numbers of the words of a text, each piece followed by the number of its end."""
    pieces = text.encode().translate(TRANSLATED).replace(b"\n", b" \n ") + b" \n"
    found = np.array(list(map(numbers.__getitem__, pieces.split(b" "))), np.uint64)
    return found[found != NO_WORD]


STORED = "part int, tokens binary, number binary, lang string, word string"
ENTERED, HELD = 1 << 14, 1 << 16  # words of a language that are written at once, and that are remembered
HELD_IN_ALL = 1 << 18  # words of all languages that a task remembers


def _spelled(seed: int, shards: int):
    """Rows of numbers of one shard, and rows of words with their number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, _Numbers] = {}
        entered: dict[str, int] = {}
        turn, waiting, size = TaskContext.get().partitionId(), [], 0

        def tokens(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal turn
            flat = np.concatenate(found)
            own = np.split(flat, _cuts(flat))
            n = len(own)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.arange(turn, turn + n) % shards, pa.int32()),
                "tokens": pa.array([x.astype("<u8").tobytes() for x in own], pa.binary()),
                "number": pa.array([None] * n, pa.binary()), "lang": pa.array([None] * n, pa.string()),
                "word": pa.array([None] * n, pa.string())})
            turn += n

        def words(lang: str) -> pa.RecordBatch:
            number, word = numbers[lang].entries(entered[lang])
            entered[lang] += len(word)
            if entered[lang] > HELD:
                del numbers[lang]
            n = len(word)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([DICTIONARY] * n, pa.int32()), "tokens": pa.array([None] * n, pa.binary()),
                "number": pa.array(number, pa.binary()), "lang": pa.array([lang] * n, pa.string()),
                "word": pa.array(word, pa.string())})

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"].to_pylist()):
                if lang not in numbers:
                    numbers[lang], entered[lang] = _Numbers(lang, seed), 2
                waiting.append(word_numbers(text.as_py(), numbers[lang]))
                size += len(waiting[-1])
                if size >= BATCH_TOKENS:
                    yield from tokens(waiting)
                    waiting, size = [], 0
                if len(numbers[lang]) - entered[lang] >= ENTERED:
                    yield words(lang)
                if sum(map(len, numbers.values())) > HELD_IN_ALL:
                    for each in list(numbers):
                        yield words(each)
                    numbers.clear()
                    entered.clear()
        if waiting:
            yield from tokens(waiting)
        for lang in list(numbers):
            yield words(lang)

    return rows


def _cuts(tokens: np.ndarray) -> np.ndarray:
    """Where to cut rows of about ``ROW_TOKENS``: after the end of a piece."""
    after = np.flatnonzero(tokens == PIECE_END) + 1
    cuts = np.unique(after[np.searchsorted(after, np.arange(ROW_TOKENS, len(tokens), ROW_TOKENS))])
    return cuts[cuts < len(tokens)]


class Corpus:
    """Stored numbers of all words by shard, and the words of all numbers."""

    def __init__(self, docs: DataFrame, shards: int = SHARDS, seed: int = 0):
        spark, self.shards = docs.sparkSession, shards
        texts = docs.select(whole_text().alias("text"),
                            F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
        while True:
            path = shared_folder(spark, "words")
            rows = texts.mapInArrow(_spelled(seed, shards), STORED)
            with _rows_at_once(spark, BATCH_TEXTS):
                rows.write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).partitionBy(
                    "part").parquet(path)
            # Vectored reads keep a buffer of the largest read for each reading thread, outside the heap.
            self.rows = spark.read.schema(rows.schema).option(
                "parquet.hadoop.vectored.io.enabled", "false").parquet(path)
            entry = F.struct("lang", "word")
            words = stored(self.rows.where(F.col("part") == DICTIONARY).groupBy("number").agg(
                F.min(entry).alias("entry"), F.max(entry).alias("other")), "dictionary")
            if words.where("entry <> other").isEmpty():
                break
            seed += 1
        #: ``number, lang, word``
        self.words = words.select("number", "entry.lang", "entry.word")

    def shard(self, number: int) -> DataFrame:
        return self.rows.where(F.col("part") == number).select("tokens")


# --- counting in a shard -----------------------------------------------------------------

ODD, GOLDEN = np.uint64(0x9FB21C651E98DF25), np.uint64(0x9E3779B97F4A7C15)


def _longer(hashes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word each."""
    mixed = hashes * ODD + tokens
    return mixed ^ (mixed >> np.uint64(29))


def slots(hashes: np.ndarray, number: int) -> np.ndarray:
    """Place of phrases in a table of this many slots, a power of two."""
    mixed = hashes * GOLDEN
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(number - 1)).astype(np.int64)


def phrase_hashes(phrases: np.ndarray) -> np.ndarray:
    """Hashes of phrases, a row of numbers each."""
    return reduce(_longer, phrases.T[1:], phrases[:, 0])


def summed(phrases: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct phrases, which of the rows has the first of each, and how many rows have it."""
    order = np.argsort(hashes, kind="stable")
    changed = hashes[order[1:]] != hashes[order[:-1]]
    same_hash = False
    for column in phrases.T:
        column = column[order]
        same_hash |= bool(((column[1:] != column[:-1]) & ~changed).any())
    if same_hash:  # of different phrases
        order = np.lexsort(phrases.T)
        changed = (phrases[order[1:]] != phrases[order[:-1]]).any(1)
    first = np.concatenate([[True], changed])[:len(order)]
    group = np.cumsum(first) - 1
    at = np.flatnonzero(first)
    return phrases[order[at]], order[at], np.bincount(group, minlength=len(at))


def counted(tokens: np.ndarray, table: np.ndarray, step: int, lengths: list[int], cycle: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Active phrases of these lengths in the numbers of words: the phrases, how often each
    occurs, and the latest step in which one of its two shorter phrases may have become frequent.

    ``table`` has the step from which phrases of a slot count as frequent, 0 if none does."""
    is_word = tokens != PIECE_END
    if 1 in lengths and is_word.any():
        words = tokens[is_word]
        phrases, _, n = summed(words[:, None], words)
        yield phrases, n, np.zeros(len(n), np.int64)
    longest = max(lengths, default=0)
    hashes, whole = tokens, is_word
    for length in range(2, longest + 1):
        if len(tokens) < length:
            return
        reached = np.zeros(len(hashes), np.uint8)
        if length in lengths:
            reached[whole] = table[slots(hashes[whole], len(table))]
        whole = whole[:-1] & is_word[length - 1:]
        if length in lengths:
            since = np.maximum(reached[:-1], reached[1:]).astype(np.int64)
            active = whole & (reached[:-1] > 0) & (reached[1:] > 0) & (since > step - cycle)
            at = np.flatnonzero(active)
            if len(at):
                phrases = np.stack([tokens[at + k] for k in range(length)], 1)
                found, which, n = summed(phrases, phrase_hashes(phrases))
                yield found, n, since[at[which]]
        if length < longest:
            hashes = _longer(hashes[:-1], tokens[length - 1:])


def _binary(phrases: np.ndarray) -> pa.Array:
    """Rows of numbers as binary values, without a copy a row."""
    width, n = phrases.shape[1] * 8, len(phrases)
    data = np.ascontiguousarray(phrases.astype("<u8", copy=False))
    return pa.Array.from_buffers(pa.binary(), n, [
        None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(data)])


def _phrases(words: pa.Array) -> np.ndarray:
    """Binary values of one width as rows of numbers."""
    return np.frombuffer(b"".join(words.to_pylist()), "<u8").reshape(len(words), -1)


SIGHTED = "words binary, fresh long, since int"
BATCH_ROWS, BATCH_TOKEN_ROWS, BATCH_TEXTS = 1 << 15, 64, 500  # rows of an Arrow batch


@contextmanager
def _set(spark: SparkSession, name: str, value: int):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _rows_at_once(spark: SparkSession, rows: int):
    """So many rows go to a Python worker at once; stored rows of numbers are large."""
    return _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


@contextmanager
def _small_reads(spark: SparkSession):
    """Tasks read ``SCAN_BYTES`` of stored files at most, and few rows of numbers go to Python at once."""
    name = "spark.sql.files.maxPartitionBytes"
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    with _set(spark, name, min(most, SCAN_BYTES)), _rows_at_once(spark, BATCH_TOKEN_ROWS):
        yield


def _scan(table: Broadcast, step: int, lengths: list[int], cycle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for phrases, n, since in counted(np.concatenate(held), table.value, step, lengths, cycle):
                for first in range(0, len(n), BATCH_ROWS):
                    cut = slice(first, first + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [_binary(phrases[cut]), pa.array(n[cut], pa.int64()), pa.array(since[cut], pa.int32())],
                        ["words", "fresh", "since"])

        held, size = [], 0
        for batch in batches:
            for tokens in batch["tokens"]:
                held.append(np.frombuffer(tokens.as_py(), "<u8"))
                size += len(held[-1])
                if size >= SCAN_TOKENS:
                    yield from sums(held)
                    held, size = [], 0
        if held:
            yield from sums(held)

    return rows


# --- steps -------------------------------------------------------------------------------

def _length() -> Column:
    return (F.octet_length("words") / 8).cast("int")


class _Table:
    """Which phrases have become frequent, by slot, as far as slots last."""

    def __init__(self, spark: SparkSession):
        self.spark, self.phrases, self.slots = spark, [], min(FIRST_SLOTS, MAX_SLOTS)
        self.steps = np.zeros(self.slots, np.uint8)

    def enter(self, newly: DataFrame, size: int, number: int) -> None:
        """``newly``: ``words, reached`` of phrases, ``number`` are known with them."""
        self.phrases.append(newly)
        wanted = min(MAX_SLOTS, 1 << (SLOTS_PER_PHRASE * number).bit_length())
        if wanted > self.slots:
            self.slots, self.steps = wanted, np.zeros(wanted, np.uint8)
            newly = reduce(DataFrame.unionAll, self.phrases)
        elif not size:
            return
        slots_ = self.slots

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                widths = np.fromiter(map(len, batch["words"].to_pylist()), np.int64, batch.num_rows)
                for width in np.unique(widths):
                    part = batch.take(pa.array(np.flatnonzero(widths == width)))
                    found = slots(phrase_hashes(_phrases(part["words"])), slots_)
                    yield pa.RecordBatch.from_arrays([pa.array(found), part["reached"]], ["slot", "reached"])

        # At most one row a slot comes to the driver.
        found = newly.mapInArrow(places, "slot long, reached int").groupBy("slot").agg(
            F.max("reached").alias("reached")).toArrow()
        at = found["slot"].to_numpy()
        self.steps[at] = np.maximum(self.steps[at], found["reached"].to_numpy().astype(np.uint8))


def frequent_phrases(corpus: Corpus, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``words, n`` of all phrases of up to ``longest`` words that occur ``least`` times, single
    words among them; and ``lang, n`` of all word occurrences."""
    spark, cycle = corpus.words.sparkSession, corpus.shards
    by_shard = [f"n{s}" for s in range(cycle)]
    total = reduce(Column.__add__, [F.coalesce(F.col(c), F.lit(0)) for c in by_shard])
    state = spark.createDataFrame([], "words binary, since int, reached int, "
                                      + ", ".join(f"{c} long" for c in by_shard))
    table, totals, known, step = _Table(spark), None, 0, 0
    latest = dict.fromkeys(range(1, longest + 1), 0)  # the last step in which a length got new frequent phrases
    while step < cycle or any(latest[k] > step - cycle for k in range(1, longest)):
        lengths = [1] if step < cycle else []
        lengths += [k for k in range(2, longest + 1) if latest[k - 1] and latest[k - 1] > step - cycle]
        own = by_shard[step % cycle]
        shared = spark.sparkContext.broadcast(table.steps)
        fresh = corpus.shard(step % cycle).mapInArrow(_scan(shared, step, lengths, cycle), SIGHTED)
        merged = state.unionByName(fresh, allowMissingColumns=True).groupBy("words").agg(
            F.max("since").alias("since"), F.max("reached").alias("reached"),
            *[F.max(c).alias(c) for c in by_shard], F.sum("fresh").alias("fresh"))
        merged = merged.withColumn(own, F.greatest(own, "fresh")).drop("fresh")
        merged = merged.withColumn("newly", F.col("reached").isNull() & (total >= least)).withColumn(
            "reached", F.coalesce("reached", F.when(total >= least, step + 1)).cast("int"))
        if step == cycle - 1:
            with _small_reads(spark):
                merged = stored(merged, "phrases")
            words = merged.where(_length() == 1).select(F.col("words").alias("number"), total.alias("n"))
            totals = stored(join_on(words, corpus.words, ["number"], how="inner").groupBy("lang").agg(
                F.sum("n").alias("n")), "totals")
        # Whose cycle is over without enough occurrences is not counted any more.
        with _small_reads(spark):
            state = stored(merged.where(
                F.col("reached").isNotNull() | (F.col("since") + cycle - 1 > step)), "phrases")
        shared.destroy()
        newly = state.where("newly").select("words", "reached")
        state = state.drop("newly")
        sizes = {row["k"]: row["size"] for row in newly.groupBy(_length().alias("k")).agg(
            F.count("*").alias("size")).collect()}  # a row a length
        known += sum(sizes.values())
        latest.update(dict.fromkeys(sizes, step + 1))
        table.enter(newly, sum(sizes.values()), known)
        step += 1
    return state.where("reached is not null").select("words", total.alias("n")), totals


# --- scores ------------------------------------------------------------------------------

def _part(first: Column, length: Column) -> Column:
    """Some of the words, from 0 on."""
    return F.substring("words", first * 8 + 1, length * 8)


def _scored(longer: DataFrame, phrases: DataFrame) -> DataFrame:
    """Adds ``l, r, score`` of the weakest cut to ``words, a, n``; ``phrases`` has ``words, n``."""
    cuts = longer.select("words", "a", "n", F.explode(F.sequence(F.lit(1), _length() - 1)).alias("cut"))
    cuts = cuts.select("words", "a", "n", "cut", _part(F.lit(0), F.col("cut")).alias("before"),
                       _part(F.col("cut"), _length() - F.col("cut")).alias("after"))
    cuts = join_on(cuts, phrases.select(F.col("words").alias("before"), F.col("n").alias("l")), ["before"], how="inner")
    cuts = join_on(cuts, phrases.select(F.col("words").alias("after"), F.col("n").alias("r")), ["after"], how="inner")
    cuts = cuts.withColumns({f"{c}_exact": F.col(c).cast("decimal(17,0)") for c in ("a", "l", "r", "n")}).withColumn(
        "score", F.expr("cast(1000 as decimal(4,0)) * (a_exact * n_exact) div (l_exact * r_exact)"))
    weakest = cuts.groupBy("words").agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
    return join_on(longer, weakest.select("words", "weakest.l", "weakest.r", "weakest.score"), ["words"], how="inner")


def _within_longer(phrases: DataFrame) -> DataFrame:
    """``words, within``: the most occurrences of a longer phrase around each phrase."""
    rows = phrases.where(_length() > 2).select("words", F.col("n").alias("within"), _length().alias("k"))
    parts = F.expr("flatten(transform(sequence(2, k - 1), size -> transform(sequence(0, k - size), "
                   "first -> substring(words, first * 8 + 1, size * 8))))")
    return rows.select(F.explode(parts).alias("words"), "within").groupBy("words").agg(
        F.max("within").alias("within"))


def _named(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Adds ``lang`` and ``phrase``, the words with a space between."""
    each = rows.select("words", F.posexplode(F.transform(
        F.sequence(F.lit(0), _length() - 1), lambda k: F.substring(F.col("words"), k * 8 + 1, F.lit(8)))).alias(
            "at", "number"))
    spelled = join_on(each, dictionary, ["number"], how="inner").groupBy("words").agg(
        F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"), F.min("lang").alias("lang"))
    return join_on(rows, spelled, ["words"], how="inner").withColumn(
        "phrase", F.array_join(F.transform("spelled", lambda x: x["word"]), " ")).drop("spelled")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 shards: int = SHARDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first phrases.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut with the lowest score
    ``floor(1000 * a * n / (l * r))`` (ties: the earliest cut), ``n`` all words. Phrases that lie
    in a longer frequent one with as many occurrences are left out.
    """
    corpus = Corpus(docs, shards)
    phrases, totals = frequent_phrases(corpus, least, longest)
    longer = join_on(phrases.where(_length() > 1).withColumnRenamed("n", "a"), _within_longer(phrases), ["words"])
    kept = longer.where(F.coalesce(F.col("within") < F.col("a"), F.lit(True))).drop("within")
    named = stored(join_on(_named(kept, corpus.words), totals, ["lang"], how="inner"), "phrases")
    scored = _scored(named, phrases)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked in salted parts first, so that a language with most phrases is no single task.
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
