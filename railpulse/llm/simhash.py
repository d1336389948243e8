"""SimHash near-duplicates by pivot distance tables.

Fingerprints: words are runs of non-space characters of the text with A-Z lowered; every
shingle of ``shingle`` words (a shorter text: all its words) is hashed by XXH64 with a seed,
and a bit of the fingerprint is set if it is set in over half of the hashes. Texts without
words have fingerprint zero, which links like any other.

Links: the fingerprints within ``radius`` bits of each other.

* Equal fingerprints are one row from the start, however many documents share them.
* A pivot table holds each fingerprint's Hamming distances to many reference fingerprints.
  By the triangle inequality, fingerprints within ``radius`` differ by no more than that in
  any coordinate: all other pairs are discarded, and survivors are verified.
* Not all pairs can be looked at, and distances to pivots do not order 64-bit fingerprints
  well enough to find neighbours by sorting. So pairs are met where ``radius`` differing
  bits must leave them equal: of ``radius + KEPT`` blocks of bits at least ``KEPT`` are
  untouched, and each choice of that many blocks is a key. This loses no pair.
* Only a spanning forest of each key's links leaves its task, so that a dense group of m
  fingerprints gives m - 1 rows and not m². A key with more fingerprints than ``BLOCK`` is
  dealt out over pairs of blocks.

``similar_documents`` is the same for a similarity of shingle sets instead of a few bits. A
Jaccard similarity of 0.8 leaves some ten of 64 bits different, too many for keys of
untouched blocks, so pairs meet in keys of ``BAND`` minima of the hashed shingles (MinHash). Sets
agree in a minimum with the probability of their similarity, however the texts were edited, and
texts that share little meet nowhere at any number of texts; so the number of keys follows from
the similarity and the wanted ``RECALL`` alone. Only keys that several texts share go on.

* Stars: in each key every text is paired with one of the key's texts, the same in all keys in the
  first round and another in every key in the second: as many pairs as rows. Wide fingerprints
  (``WIDE`` words) discard pairs that are clearly less alike; the others are joined to their shingle
  sets, and link if their Jaccard similarity is at least the one asked for.
* The rest: keys whose texts are not all connected by then are looked at whole. Fingerprints of
  ``FINE`` words, made of the texts in such keys only, and their pivot tables discard pairs inside a
  key's task, the shingle sets of those that remain across components are compared right there,
  and a forest of the links found leaves it. So every pair that meets and passes the filter is
  either verified or connected by links that are, and a group of m texts makes no more than m
  rows a key and block pair, however alike they are. A fine fingerprint passes 0.8 but for one
  pair in 4,000.

Null texts are empty, null ids keep their rows and never name a component (a component of
null ids only has a null name), repeated rows stay. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm.components import connected_components
from railpulse.llm.tables import stored, whole_text
from railpulse.operators.timetable import join_on

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
RADIUS, KEPT, PIVOTS, BLOCK = 4, 3, 32, 4096
WIDE, RECALL, SPREAD, BAND = 8, 0.995, 5.5, 5
FINE, FINE_SPREAD, FINE_BLOCK = 64, 3.5, 1 << 12


def shingle_hashes(text: str, shingle: int, seed: int) -> tuple[np.ndarray, list[bytes]]:
    """XXH64 of every shingle, repeats included, and the words."""
    words = WORDS.findall(text.encode().lower())  # bytes.lower() lowers A-Z only
    if not words:
        return np.zeros(0, np.uint64), words
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    begins = [0, *[end + 1 for end in ends[:-1]]]
    span = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[b:e], seed) for b, e in zip(begins, ends[span:])], np.uint64), words


def majority(hashes: np.ndarray) -> np.ndarray:
    """Per row of hashes, the bits that are set in over half of them, as one number."""
    rows, n = hashes.shape
    if not n:
        return np.zeros(rows, np.uint64)
    block = min(n, 255)
    padded = np.zeros((rows, -(-n // block) * block), np.uint64)
    padded[:, :n] = hashes
    padded = padded.reshape(rows, -1, block)
    ones = np.zeros((rows, 64), np.int64)
    lanes = np.uint64(0x0101010101010101)
    for shift in range(8):  # eight bits at a time, in byte lanes of at most 255 hashes
        sums = ((padded >> np.uint64(shift)) & lanes).sum(2, dtype=np.uint64)
        ones[:, shift::8] = sums.astype("<u8").view(np.uint8).reshape(rows, -1, 8).sum(1, dtype=np.int64)
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    return int(majority(shingle_hashes(text, shingle, seed)[0][None, :])[0])


STEPS = np.array([(0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF for k in range(FINE)], np.uint64)


def wide_majority(hashes: np.ndarray, words: int = WIDE) -> bytes:
    """``words`` times 64 bits, from as many hashes made of each one (SplitMix64's finish)."""
    if words > WIDE:  # some at a time, for long texts
        return b"".join(_majority_bytes(hashes, STEPS[first:first + WIDE]) for first in range(0, words, WIDE))
    return _majority_bytes(hashes, STEPS[:words])


def _majority_bytes(hashes: np.ndarray, steps: np.ndarray) -> bytes:
    mixed = hashes[None, :] + steps[:, None]
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return majority(mixed ^ (mixed >> np.uint64(31))).astype(">u8").tobytes()


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed 64-bit integer."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), shingle, seed) for text in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))],
                                             ["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        rows, "doc_id long, bits long")


def block_masks(radius: int = RADIUS, kept: int = KEPT) -> list[int]:
    """One mask per choice of ``kept`` blocks out of ``radius + kept``, as signed integers."""
    edges = [round(64 * i / (radius + kept)) for i in range(radius + kept + 1)]
    blocks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(blocks, kept)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def distances(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints; the last axis holds their 64-bit words."""
    return np.bitwise_count(one ^ others).sum(-1, dtype=np.int16)


def reference_fingerprints(number: int = PIVOTS, words: int = 1, seed: int = 9) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, (number, words), dtype=np.uint64)


def links_within(prints: np.ndarray, pivots: np.ndarray, radius: int, sides: np.ndarray | None = None,
                 earlier: np.ndarray | None = None, known: np.ndarray | None = None,
                 sets: np.ndarray | None = None, similarity: float = 0.8) -> list[tuple[int, int]]:
    """Spanning forest of the links of one key's fingerprints (a row each), as pairs of rows.

    With ``sides``, only pairs from different sides count. With ``earlier``, the masks of
    keys before this one, pairs that have such a key in common don't, as they meet there.
    With ``known``, the components so far, and the fingerprints' ``sets``, pairs of a component
    don't count, and others only if their sets have this Jaccard similarity.
    """
    table = np.stack([distances(prints, pivot) for pivot in pivots], 1)
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    if sides is not None:
        sides = sides[order]
    stops = np.searchsorted(table[:, 0], table[:, 0] + radius, "right")
    root = list(range(len(prints)))
    if known is not None:
        sets, first = sets[order], {}
        root = [first.setdefault(component, i) for i, component in enumerate(known[order].tolist())]

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    forest = []
    for i in range(len(prints) - 1):
        near = np.arange(i + 1, stops[i])
        if len(near):  # the pairs left by the first pivot, by all others
            near = near[(np.abs(table[near, 1:] - table[i, 1:]) <= radius).all(1)]
        near = near[distances(prints[i], prints[near]) <= radius]
        if sides is not None:
            near = near[sides[near] != sides[i]]
        for j in near.tolist():
            if earlier is not None and ((prints[i] ^ prints[j]) & earlier == 0).any():
                continue
            a, b = top(i), top(j)
            if a != b and (sets is None or alike(sets[i], sets[j], similarity)):
                root[max(a, b)] = min(a, b)
                forest.append((int(order[i]), int(order[j])))
    return forest


def alike(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    """Whether two sets have at least this Jaccard similarity."""
    least = math.ceil((len(one) + len(two)) * similarity / (1 + similarity) - 1e-9)  # of what both have
    return min(len(one), len(two)) >= least and len(np.intersect1d(one, two, assume_unique=True)) >= least


def _sets(column: pa.Array) -> np.ndarray:
    found = np.empty(len(column), object)
    for k, hashes in enumerate(column):
        found[k] = hashes.values.to_numpy().copy()
    return found


def bucket_links(keyed: DataFrame, radius: int, pivots: np.ndarray, masks: np.ndarray | None = None,
                 block: int = BLOCK, similarity: float = 0.8) -> DataFrame:
    """Pairs ``a, b`` of nodes that connect those within ``radius`` that share a ``tab, key``.

    ``keyed``: ``tab, key, node, print`` with the fingerprint's words as big-endian bytes. Rows of keys
    with more than ``block`` rows go to every pair of blocks with their own. If there are columns
    ``known``, the component so far, and ``hashes``, the set, the pairs are those across components
    whose sets have the similarity.
    """
    large = keyed.groupBy("tab", "key").count().where(F.col("count") > block).select(
        "tab", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    dealt = join_on(keyed, large, ["tab", "key"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", F.explode(
        F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
        .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    names, more = ["tab", "key", "low", "high"], [c for c in ("known", "hashes") if c in keyed.columns]
    dealt = dealt.select("tab", "key", F.least("own", "other").alias("low"),
                         F.greatest("own", "other").alias("high"), "node", "own", "print", *more)
    words = pivots.shape[1]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def closed(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys, found = np.stack(columns[:4]), []
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [keys.shape[1]]])
            for begin, end in zip(begins[ends - begins > 1], ends[ends - begins > 1]):
                nodes, prints = columns[4][begin:end], columns[6][begin:end]
                sides = columns[5][begin:end] if columns[2][begin] != columns[3][begin] else None
                earlier = masks[:columns[0][begin]] if masks is not None else None
                known, sets = (c[begin:end] for c in columns[7:]) if more else (None, None)
                found += [(nodes[i], nodes[j]) for i, j in links_within(
                    prints, pivots, radius, sides, earlier, known, sets, similarity)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch[c].to_numpy().astype(np.int64) for c in (*names, "node", "own")]
            columns.append(np.frombuffer(b"".join(batch["print"].to_pylist()), ">u8").reshape(-1, words)
                           .astype(np.uint64))
            if more:
                columns += [batch["known"].to_numpy().astype(np.int64), _sets(batch["hashes"])]
            columns = [np.concatenate(pair) for pair in zip(held, columns)] if held else columns
            keys = np.stack(columns[:4])
            ended = np.flatnonzero((keys != keys[:, -1:]).any(0))
            last = int(ended[-1]) + 1 if len(ended) else 0  # where the key that may go on begins
            if last:
                yield from closed([c[:last] for c in columns])
            held = [c[last:] for c in columns]
        if held:
            yield from closed(held)

    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(links, "a long, b long")


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, kept: int = KEPT,
                      block: int = BLOCK) -> DataFrame:
    """Pairs ``a, b`` that connect the distinct ``bits`` within ``radius`` of each other."""
    masks = block_masks(radius, kept)
    choices = F.array(*[F.struct(F.lit(i).alias("tab"), F.col("bits").bitwiseAND(F.lit(m)).alias("key"))
                        for i, m in enumerate(masks)])
    keyed = distinct.select(F.col("bits").alias("node"), F.inline(choices),
                            F.unhex(F.lpad(F.hex("bits"), 16, "0")).alias("print"))
    return bucket_links(keyed, radius, reference_fingerprints(), np.array(masks, np.int64).view(np.uint64), block)


def near_duplicates(docs: DataFrame, shingle: int = 4, seed: int = 42, radius: int = RADIUS) -> DataFrame:
    """``doc_id, bits, component_id``; the smallest id of all documents reachable by links."""
    prints = stored(fingerprints(docs, shingle, seed), "fingerprints")
    groups = prints.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    linked = connected_components(stored(fingerprint_links(groups.select("bits"), radius), "pairs"))
    named = join_on(groups, linked.withColumnRenamed("node", "bits"), ["bits"]).withColumn(
        "component", F.coalesce("component", "bits"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    members = join_on(named.select("bits", "component"), names, ["component"])
    return join_on(prints, members.select("bits", "component_id"), ["bits"])


# --- by similarity ---------------------------------------------------------------------

def differing_share(similarity: float) -> float:
    """Expected share of differing bits of sets with a Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def wide_radius(similarity: float, words: int = WIDE, spread: float = SPREAD) -> int:
    """Differing bits up to which fingerprints link: ``spread`` deviations above the expectation."""
    bits, share = 64 * words, differing_share(similarity)
    return round(bits * share + spread * math.sqrt(bits * share * (1 - share)))


def number_of_keys(similarity: float, recall: float = RECALL) -> int:
    """Keys of ``BAND`` minima so that sets of this similarity share one with the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** BAND))


@cache
def permutations(number: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(3).integers(0, 1 << 64, (2, number, 1), np.uint64)
    return drawn[0], drawn[1] | np.uint64(1)


def minima_keys(hashes: np.ndarray, keys: int) -> list[int]:
    """A key per ``BAND`` minima of the hashes, each under a permutation of its own; a set's keys."""
    masks, factors = permutations(keys * BAND)
    least = np.full(keys * BAND, np.iinfo(np.uint64).max)
    for first in range(0, len(hashes), 1024):
        mixed = (hashes[None, first:first + 1024] ^ masks) * factors
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(31))).min(1))
    return [xxhash.xxh64_intdigest(band.tobytes()) for band in least.reshape(keys, BAND)]


def wide_fingerprints(docs: DataFrame, shingle: int, keys: int, seed: int = 42) -> DataFrame:
    """``doc_id`` and, of the set of shingles, ``print``, ``minima``, which are its keys, and ``digest``, as bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, minima, digests = [], [], []
            for text in batch["text"]:
                distinct = np.unique(shingle_hashes(text.as_py(), shingle, seed)[0])  # a repeat counts once
                prints.append(wide_majority(distinct))
                minima.append(np.array(minima_keys(distinct, keys), np.uint64).tobytes())
                digests.append(xxhash.xxh128_digest(distinct.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(made, pa.binary()) for made in (prints, minima, digests)]],
                ["doc_id", "print", "minima", "digest"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        rows, "doc_id long, print binary, minima binary, digest binary")


def shingle_sets(docs: DataFrame, nodes: DataFrame, shingle: int, seed: int = 42) -> DataFrame:
    """``node, hashes``: the set of shingles of every text of these nodes, which are ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 200):  # sets are larger than texts
                part = batch.slice(first, 200)
                sets = [np.unique(shingle_hashes(text.as_py(), shingle, seed)[0]).view(np.int64)
                        for text in part["text"]]
                yield pa.RecordBatch.from_arrays([part["node"], pa.array(sets, pa.list_(pa.int64()))],
                                                 ["node", "hashes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), whole_text().alias("text"))
    # Nodes with a candidate grow with the documents, so they are never broadcast.
    return texts.join(nodes.hint("merge"), "node", "left_semi").mapInArrow(
        rows, "node long, hashes array<long>").dropDuplicates(["node", "hashes"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` with sets of at least this Jaccard similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("a_hashes"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("b_hashes"))
    met = join_on(join_on(pairs, one, ["a"], how="inner"), two, ["b"], how="inner")
    sizes = F.size("a_hashes"), F.size("b_hashes")
    least = F.ceil((sizes[0] + sizes[1]) * similarity / (1 + similarity) - 1e-9)  # of what both have
    return met.where((F.least(*sizes) >= least) & (F.size(F.array_intersect("a_hashes", "b_hashes")) >= least)).select(
        "a", "b").distinct()


def fine_fingerprints(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, print, hashes``: sets of these nodes and their fingerprints of ``FINE`` words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [wide_majority(hashes.values.to_numpy().view(np.uint64), FINE) for hashes in batch["hashes"]]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(prints, pa.binary()), batch["hashes"]],
                                             ["node", "print", "hashes"])

    return join_on(sets, nodes, ["node"], how="inner").select("node", "hashes").mapInArrow(
        rows, "node long, print binary, hashes array<long>")


def star_pairs(keyed: DataFrame, same_in_all_keys: bool) -> DataFrame:
    """Pairs ``a < b`` of each text with the centre of each of its keys, across components.

    ``keyed``: ``tab, key, node, known``. The centre is the text with the smallest hash, which
    depends on the key's number too unless it is to be the same in all keys.
    """
    drawn = F.xxhash64("node") if same_in_all_keys else F.xxhash64("node", "tab")
    centres = keyed.groupBy("tab", "key").agg(
        F.min(F.struct(drawn.alias("drawn"), "node", "known")).alias("centre"),
        F.min("known").alias("first"), F.max("known").alias("last")).where("first <> last").select(
            "tab", "key", F.col("centre.node").alias("centre"), F.col("centre.known").alias("centre_known"))
    met = join_on(keyed, centres, ["tab", "key"], how="inner").where("known <> centre_known")
    return met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def within_wide(pairs: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """The pairs whose wide fingerprints differ in no more bits. ``prints``: ``node, words``."""
    for side in ("a", "b"):
        pairs = join_on(pairs, prints.select(F.col("node").alias(side), F.col("words").alias(f"{side}_words")),
                        [side], how="inner")
    differ = F.aggregate(F.zip_with("a_words", "b_words", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                         lambda total, n: total + n)
    return pairs.where(differ <= radius).select("a", "b")


def similar_documents(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, component_id`` of the smallest id of each group of equal sets of shingles.

    Groups whose ids are all null are left out.
    """
    number = number_of_keys(similarity)
    prints = stored(wide_fingerprints(docs, shingle, number), "fingerprints")
    groups = stored(prints.groupBy("digest", "print", "minima").agg(F.min("doc_id").alias("node"))
                    .where("node is not null"), "groups")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                found = np.frombuffer(b"".join(part["minima"].to_pylist()), np.int64).reshape(-1, number).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(number, dtype=np.int32), part.num_rows)), pa.array(found.ravel()),
                     part["node"].take(pa.array(np.tile(np.arange(part.num_rows), number)))], ["tab", "key", "node"])

    every = groups.select("minima", "node").mapInArrow(keys, "tab int, key long, node long")
    shared = every.groupBy("tab", "key").count().where("count > 1").select("tab", "key")
    keyed = stored(join_on(every, shared, ["tab", "key"], how="inner").select("tab", "key", "node"), "keys")
    nodes = stored(keyed.select("node").distinct(), "nodes")
    sets = stored(shingle_sets(docs, nodes, shingle), "sets")
    words = stored(join_on(groups.select("node", "print"), nodes, ["node"], how="inner").select("node", F.transform(
        F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda k: F.conv(F.hex(F.substring(F.col("print"), k * 8 + 1, F.lit(8))), 16, -10)
        .cast("long")).alias("words")), "words")
    links = None
    known = nodes.select("node", F.col("node").alias("known"))
    for turn in range(2):
        pairs = star_pairs(join_on(keyed, known, ["node"], how="inner"), same_in_all_keys=not turn)
        near = stored(within_wide(pairs, words, wide_radius(similarity)), "candidates")
        found = stored(verified(near, sets, similarity), "verified")
        links = found if links is None else links.unionAll(found)
        known = _components_of(nodes, links)
    # Keys with texts of several components, whole.
    left = join_on(keyed, known, ["node"], how="inner")
    open_keys = left.groupBy("tab", "key").agg(F.min("known").alias("first"), F.max("known").alias("last")).where(
        "first <> last").select("tab", "key")
    left = stored(join_on(left, open_keys, ["tab", "key"], how="inner").select("tab", "key", "node", "known"), "open")
    fine = stored(fine_fingerprints(sets, left.select("node").distinct()), "fine")
    more = stored(bucket_links(join_on(left, fine, ["node"], how="inner"), wide_radius(similarity, FINE, FINE_SPREAD),
                               reference_fingerprints(8, FINE), block=FINE_BLOCK, similarity=similarity), "verified")
    if not more.isEmpty():
        known = _components_of(nodes, links.unionAll(more))
    return join_on(groups.select("node"), known, ["node"]).select(
        F.col("node").alias("doc_id"), F.coalesce("known", "node").alias("component_id"))


def _components_of(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, known``: the smallest node of the component of each."""
    return stored(join_on(nodes, connected_components(links), ["node"]).select(
        "node", F.coalesce("component", "node").alias("known")), "components")


def first_of_each(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The document with the smallest id of each group of similar ones.

    Rows that share an id stay or go together; rows with a null id stay.
    """
    kept = similar_documents(docs, shingle, similarity).where("doc_id = component_id").select("doc_id")
    # What is kept grows with the documents, so it is never broadcast.
    with_id = docs.where(F.col("doc_id").isNotNull()).join(
        kept.hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    return with_id.unionAll(docs.where(F.col("doc_id").isNull()))
