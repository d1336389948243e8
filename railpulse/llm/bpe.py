"""BPE encoding and decoding by an index of pair occurrences.

Per chunk of a partition the distinct words of its texts are laid out in one array of
symbols, linked to their neighbours. An index maps every mergeable pair to all its positions
in the chunk. Ranks that occur ("active" ones) are applied in ascending order from a heap:
one step merges a pair at all its positions at once and enters the pairs this creates into
the lists of their ranks. A merge's parts are always made by lower ranks, so a rank never
comes back once applied and the result is that of merging each word by itself.

Words come from the byte-level pattern. Texts with characters from U+0500 on are split by
the tokenizers library's own pre-tokenizer, as Unicode tables of pattern engines differ
there. Special tokens written in a text get their id. Null texts are empty; null ids and
repeated rows are kept; other columns are ignored. Decoding replaces bytes that are no
UTF-8 by U+FFFD, as the library does; null lists of ids decode to null.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from railpulse.llm import tokens
from railpulse.llm.tables import whole_text

CHUNK_CHARS = 6_000_000
PLAIN = re.compile("[^\x00-ӿ]")
GONE, EDGE = -2, -1


class PairMerger:
    """Merges of one vocabulary, and their application to many words at once."""

    def __init__(self, path: str):
        words = tokens.vocabulary(path)
        self.special, self.ids, self.size = words.special, words.ids, words.size
        self.byte_ids = np.array([words.ids[bytes([b])] for b in range(256)], np.int32)
        parts = np.array([[words.ids[a], words.ids[b], words.ids[a + b]] for a, b in words.merges], np.int64)
        made_at = np.full(self.size, -1, np.int64)
        made_at[parts[:, 2]] = np.arange(len(parts))
        if (made_at[parts[:, 0]] >= np.arange(len(parts))).any() or (
                made_at[parts[:, 1]] >= np.arange(len(parts))).any():
            raise ValueError("a merge uses a symbol that only a later merge makes")
        self.left, self.right, self.made = parts.T.astype(np.int32)
        keys = parts[:, 0] * self.size + parts[:, 1]
        self._by_key = np.argsort(keys)
        self._keys = keys[self._by_key]
        self.pattern = regex.compile(tokens.WORD_PATTERN)
        self.splitter = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self._alphabet = tokens.byte_alphabet()

    def words(self, text: str) -> list[str | bytes | int]:
        """Words of a text: text or bytes to merge, or the number of a special token."""
        if self.splitter is None or not any(token in text for token in self.special):
            return self._plain_words(text)
        found: list[str | bytes | int] = []
        for k, part in enumerate(self.splitter.split(text)):
            if k % 2:
                found.append(self.special[part])
            elif part:
                found.extend(self._plain_words(part))
        return found

    def _plain_words(self, text: str) -> list:
        if PLAIN.search(text) is None:
            return self.pattern.findall(text)
        return [bytes(map(self._alphabet.__getitem__, word)) for word, _ in self.library.pre_tokenize_str(text)]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where there is none."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._by_key[at], -1)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"\0".join([b"", *words, b""]), np.uint8)  # an edge before, between and after
        begins = 1 + np.cumsum(lengths + 1) - (lengths + 1)
        symbols = self.byte_ids[raw].copy()
        edges = np.concatenate([begins - 1, [len(raw) - 1]])
        symbols[edges] = EDGE
        after = np.arange(1, len(raw) + 1, dtype=np.int32)
        before = np.arange(-1, len(raw) - 1, dtype=np.int32)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            begin = int(np.searchsorted(ranks, 0))
            positions, ranks = positions[begin:], ranks[begin:]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for low, high in zip(cuts, cuts[1:]):
                if low < high:
                    rank = int(ranks[low])
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(active, rank)
                    index[rank].append(positions[low:high])

        enter(np.arange(len(raw) - 1, dtype=np.int32), self._ranks(symbols[:-1], symbols[1:]))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            left, right, made = self.left[rank], self.right[rank], self.made[rank]
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[symbols[at] == left]
            at = at[symbols[after[at]] == right]
            if left == right and len(at) > 1:  # of a run of equal symbols, every second pair merges
                starts = np.concatenate([[True], after[at[:-1]] != at[1:]])
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                at = at[run % 2 == 0]
            if not len(at):
                continue
            taken = after[at]
            following = after[taken]
            symbols[at], symbols[taken] = made, GONE
            after[at], before[following] = following, at
            leading = before[at]
            enter(np.concatenate([leading, at]),
                  self._ranks(np.concatenate([symbols[leading], symbols[at]]),
                              np.concatenate([symbols[at], symbols[following]])))
        kept = symbols >= 0
        counts = np.add.reduceat(kept, begins, dtype=np.int64) if len(words) else np.zeros(0, np.int64)
        return symbols[kept], np.where(lengths > 0, counts, 0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        numbers: dict[str | bytes | int, int] = {}
        number = numbers.setdefault
        spelled = [np.array([number(w, len(numbers)) for w in self.words(text)], np.int32) for text in texts]
        flat, counts = self.merged([w.encode() if isinstance(w, str) else w if isinstance(w, bytes) else b"?"
                                    for w in numbers])
        begins = np.cumsum(counts) - counts
        for word, k in numbers.items():
            if isinstance(word, int):
                flat[begins[k]] = word
        out, sizes = [], np.zeros(len(texts), np.int64)
        for t, found in enumerate(spelled):
            size = counts[found]
            shift = begins[found] - (np.cumsum(size) - size)
            out.append(flat[np.repeat(shift, size) + np.arange(size.sum())])
            sizes[t] = len(out[-1])
        return np.concatenate([np.zeros(0, np.int32), *out]), sizes


@lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


@lru_cache(maxsize=2)
def spellings(path: str) -> dict[int, bytes]:
    words = tokens.vocabulary(path)
    return {n: w for w, n in words.ids.items()} | {n: t.encode() for t, n in words.special.items()}


def chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters with the place of their first."""
    first, held, size = 0, [], 0
    for k, value in enumerate(column):
        text = value.as_py()
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = k, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def encoded(docs: DataFrame, tokenizer: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id`` and ``ids``, as the tokenizers library gives without added special tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch["text"], chunk_chars):
                ids, sizes = merger(tokenizer).encode(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(texts)),
                     pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        encode, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Adds ``text`` to rows of ``doc_id, ids``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = spellings(tokenizer).__getitem__
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [None if not ids.is_valid else
                         b"".join(map(spelling, ids.values.to_numpy().tolist())).decode("utf-8", "replace")
                         for ids in part["ids"]]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], pa.array(texts, pa.string())],
                                                 ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, text string")
