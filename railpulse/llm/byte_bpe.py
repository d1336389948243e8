"""Byte-level BPE from a file of ranks, with vectorised pre-tokenisation.

Words are cut without matching a pattern on the texts. Each character of a chunk of texts gets
a class (letter, number, space, ...; apostrophes and spaces also by what follows them). A class
is a function from the state before a character to the state after it; functions compose
associatively, so the states of all characters come from one parallel scan: blocks of
characters are composed side by side, the blocks' functions are scanned, and the states run
through all blocks side by side. A word begins wherever state and class say so.

The words feed a cache of merged words, of bounded size; a word that is not in it is merged by
ascending rank. Each id keeps the byte offset where its token ends, by which decoding places
the tokens' bytes.

Letters, numbers and white space are those of the library's own tables, asked once a process.
Null texts are empty, null ids and repeated rows are kept, other columns are ignored. Decoding
gives bytes, null for null ids; an id that is not in the file raises ``KeyError``.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm.tables import whole_text

CHUNK_CHARS = 2_000_000
CACHED_WORDS = 400_000
CACHED_LENGTH = 64  # longer words are merged anew each time
BLOCK = 512

# Endings after an apostrophe that make a word of their own.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Classes of characters. A white space is "last" if a character that is none follows it.
OTHER, LETTER, NUMBER, SPACE_LAST, BLANK_LAST, BLANK_INNER, QUOTE_ONE, QUOTE_TWO, END = range(9)
# States: what the character before belongs to.
FRESH, IN_OTHER, IN_LETTERS, IN_NUMBERS, JOINING, IN_BLANKS, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """State after a character of this class, and whether a word begins with it."""
    if kind == LETTER:
        if state in (ONE_MORE, TWO_MORE):
            return (FRESH if state == ONE_MORE else ONE_MORE), False
        return IN_LETTERS, state not in (IN_LETTERS, JOINING)
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, JOINING)
    if kind == OTHER:
        return IN_OTHER, state not in (IN_OTHER, JOINING)
    if kind in (QUOTE_ONE, QUOTE_TWO):
        if state in (IN_OTHER, JOINING):
            return IN_OTHER, False
        return (ONE_MORE if kind == QUOTE_ONE else TWO_MORE), True
    if kind == BLANK_INNER:
        return IN_BLANKS, state != IN_BLANKS
    return (JOINING if kind == SPACE_LAST else FRESH), True


class Scanner:
    """The transition functions, closed under composition, and scans by them."""

    def __init__(self):
        states, kinds = range(FRESH, TWO_MORE + 1), range(OTHER, END + 1)
        self.after = np.array([[_step(s, k)[0] for k in kinds] for s in states], np.uint8)
        self.begins = np.array([[_step(s, k)[1] for k in kinds] for s in states])
        functions = {tuple(states): 0}
        todo = list(functions)
        generators = [tuple(self.after[:, k].tolist()) for k in kinds]
        while todo:
            one = todo.pop()
            for two in generators:
                both = tuple(two[s] for s in one)
                if both not in functions:
                    functions[both] = len(functions)
                    todo.append(both)
        listed = list(functions)
        self.product = np.array([[functions[tuple(two[s] for s in one)] for two in listed] for one in listed],
                                np.uint16)
        self.of_class = np.array([functions[g] for g in generators], np.uint16)
        self.from_fresh = np.array([f[FRESH] for f in listed], np.uint8)

    def states_before(self, kinds: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """The state before each character; the first is fresh."""
        rows = -(-len(kinds) // block)
        padded = np.full(rows * block, END, np.uint8)
        padded[:len(kinds)] = kinds
        columns = np.ascontiguousarray(padded.reshape(rows, block).T)
        composed = np.zeros(rows, np.uint16)
        for column in columns:
            composed = self.product[composed, self.of_class[column]]
        shift = 1
        while shift < rows:
            composed = np.concatenate([composed[:shift], self.product[composed[:-shift], composed[shift:]]])
            shift *= 2
        state = np.concatenate([np.array([FRESH], np.uint8), self.from_fresh[composed[:-1]]])
        found = np.empty_like(columns)
        for k, column in enumerate(columns):
            found[k] = state
            state = self.after[state, column]
        return found.T.reshape(-1)[:len(kinds)]


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


@lru_cache(maxsize=1)
def plain_classes() -> np.ndarray:
    """Class of every code point by itself; white space counts as inner."""
    points = np.concatenate([np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")])
    every = points.tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK_INNER)):
        # What matches nothing is left out of the ids, so these are the bytes of all matches.
        asked = tiktoken.Encoding("class", pat_str=pattern, special_tokens={},
                                  mergeable_ranks={bytes([b]): b for b in range(256)})
        found = bytes(asked.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return table


def classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of the characters of texts that stand one after the other, each with one more
    character after it, at ``ends``, which belongs to no text."""
    kinds = plain_classes()[points]
    kinds[ends] = END
    following = np.append(kinds[1:], END)
    last = (kinds == BLANK_INNER) & (following != BLANK_INNER) & (following != END)
    kinds[last] = np.where(points[last] == ord(" "), SPACE_LAST, BLANK_LAST)
    quotes = np.flatnonzero((points == ord("'")) & (kinds == OTHER) & (following == LETTER))
    quotes = quotes[quotes + 2 < len(points)]
    one, two = points[quotes + 1], points[quotes + 2]
    kinds[quotes[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = QUOTE_ONE
    for a, b in LONG_ENDINGS:
        kinds[quotes[(one == ord(a)) & (two == ord(b)) & (kinds[quotes + 2] == LETTER)]] = QUOTE_TWO
    return kinds


def word_slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes with one more byte after each, where words begin and end in them, and
    the number of words of each text."""
    joined = "\0".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kinds = classes(points, ends)
    begins = scanner().begins[scanner().states_before(kinds), kinds]
    first = np.flatnonzero(begins)
    sizes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
    places = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    until = np.append(first[1:], len(points))
    kept = kinds[first] != END
    first, until = first[kept], until[kept]
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    return joined.encode(), places[first], places[until], counts


class RankMerger:
    """Merges of one file of ranks, with the cache of merged words."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.cache: dict[bytes, tuple[int, ...]] = {}
        size = 1 + max(self.ranks.values())
        lengths = np.zeros(size, np.int64)
        for token, rank in self.ranks.items():
            lengths[rank] = len(token)
        spelled = {rank: token for token, rank in self.ranks.items()}
        self.lengths = lengths
        self.spelling = np.frombuffer(b"".join(spelled.get(rank, b"") for rank in range(size)), np.uint8)
        self.places = np.cumsum(lengths) - lengths

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word."""
        whole = self.ranks.get(word)
        if whole is not None:
            return (whole,)
        return self._merge_short(word) if len(word) <= CACHED_LENGTH else self._merge_long(word)

    def _merge_short(self, word: bytes) -> tuple[int, ...]:
        rank_of, never = self.ranks.get, len(self.lengths)
        parts = [word[i:i + 1] for i in range(len(word))]
        ranks = [rank_of(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == never:
                break
            i = ranks.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] + parts[i + 1], never)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] + parts[i], never)
        return tuple([self.ranks[part] for part in parts])

    def _merge_long(self, word: bytes) -> tuple[int, ...]:
        """The same by a heap of pairs, in about linear time."""
        n, rank_of = len(word), self.ranks.get
        stop = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is taken
        begin = list(range(-1, n))  # where the part before begins
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := rank_of(word[i:i + 2])) is not None]
        heapq.heapify(heap)

        def enter(i: int, end: int) -> None:
            rank = rank_of(word[i:end])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end))

        while heap:
            _, i, end = heapq.heappop(heap)
            middle = stop[i]
            if not middle or middle >= n or stop[middle] != end:  # a part has changed since
                continue
            stop[i], stop[middle] = end, 0
            if end < n:
                begin[end] = i
                enter(i, stop[end])
            if begin[i] >= 0:
                enter(begin[i], end)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i:stop[i]]])
            i = stop[i]
        return tuple(ids)

    def _cached(self, word: bytes) -> tuple[int, ...]:
        ids = self.cache.get(word)
        if ids is None:
            ids = self.merge(word)
            if len(word) <= CACHED_LENGTH:
                if len(self.cache) >= CACHED_WORDS:
                    self.cache.clear()
                self.cache[word] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, the byte of its text where each ends, and the
        number of ids of each text."""
        data, begins, ends, words = word_slices(texts)
        numbers: dict[bytes, int] = {}
        enter = numbers.setdefault
        found = np.array([enter(data[b:e], len(numbers)) for b, e in zip(begins.tolist(), ends.tolist())],
                         np.int64)
        merged = list(map(self._cached, numbers))
        counts = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.fromiter(chain.from_iterable(merged), np.int64, int(counts.sum()))
        sizes = counts[found]
        shift = (np.cumsum(counts) - counts)[found] - (np.cumsum(sizes) - sizes)
        ids = flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
        until = np.cumsum(words)
        totals = np.diff(np.concatenate([[0], np.cumsum(sizes)])[until], prepend=0)
        token_ends = np.cumsum(self.lengths[ids])
        first = np.cumsum(totals) - totals
        before = np.concatenate([[0], token_ends])[first]
        return ids.astype(np.int32), token_ends - np.repeat(before, totals), totals

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """Bytes of one text's ids, each placed by the byte where it ends."""
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.lengths) or (self.lengths[ids] == 0).any():
            raise KeyError("an id that is not in the file of ranks")
        sizes = self.lengths[ids]
        shift = self.places[ids] - (ends - sizes)
        return self.spelling[np.repeat(shift, sizes) + np.arange(int(ends[-1]))].tobytes()


@lru_cache(maxsize=2)
def merger(path: str) -> RankMerger:
    return RankMerger(path)


def _chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters with the place of their first."""
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


def _lists(values: np.ndarray, kind: pa.DataType, sizes: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def encoded(docs: DataFrame, ranks: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id``, ``ids`` and ``ends``, the byte where each token ends, of every whole text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch["text"], chunk_chars):
                ids, ends, sizes = merger(ranks).encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(texts)), _lists(ids, pa.int32(), sizes),
                     _lists(ends, pa.int64(), sizes)], ["doc_id", "ids", "ends"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        encode, "doc_id long, ids array<int>, ends array<long>")


def decoded(rows: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids, content``: the bytes of every list of ids and their ends."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merger(ranks)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                contents = [None if not (ids.is_valid and ends.is_valid) else own.decode(
                    ids.values.to_numpy(), ends.values.to_numpy()) for ids, ends in zip(part["ids"], part["ends"])]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], pa.array(contents, pa.binary())],
                                                 ["doc_id", "ids", "content"])

    return rows.select("doc_id", "ids", "ends").mapInArrow(
        decode, "doc_id long, ids array<int>, content binary")
