"""Run-length grammar of a sequence by recompression, and longest common extensions from it.

Levels alternate between block compression (a maximal block of one symbol becomes a symbol) and
pair compression (symbols are dealt to a left and a right side by a hash, and every left symbol
before a right one becomes a symbol with it) until one symbol is left (Jeż 2013; extensions
after I 2017). What becomes of a symbol depends on its neighbours only, so equal stretches are
compressed alike except at their ends. Two positions therefore climb the levels together:
where one of them is inside a symbol of the next level, at most one block or one symbol has to
be compared until both are at a boundary. When that comparison fails, they climb down again,
with at most one block or symbol equal on each level. So an answer takes a few steps a level,
in either direction, exactly, and many answers are computed at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCKS, PAIRS = "blocks", "pairs"


@dataclass
class Level:
    """Symbols with an end mark, and how they make up those of the next level."""

    symbols: np.ndarray
    kind: str
    above: np.ndarray  # of each symbol, and of the end: the place of its symbol on the next level
    first: np.ndarray  # of each symbol of the next level, and of its end: its first place here


def _mixed(symbols: np.ndarray, seed: int) -> np.ndarray:
    """A hash bit of each symbol (the finish of SplitMix64)."""
    x = symbols.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) & np.uint64(1)).astype(bool)


def _renamed(one: np.ndarray, two: np.ndarray, unused: int) -> tuple[np.ndarray, int]:
    """New symbols for pairs of numbers, and the next one that is unused."""
    known, names = np.unique(one * (int(two.max()) + 1) + two, return_inverse=True)
    return unused + names, unused + len(known)


class Grammar:
    """The levels over a sequence of numbers from 0 on."""

    def __init__(self, sequence: np.ndarray):
        symbols = np.asarray(sequence, np.int64)
        self.length = len(symbols)
        self.levels: list[Level] = []
        unused, seed = int(symbols.max(initial=0)) + 1, 0
        while len(symbols) > 1:
            starts = np.concatenate([[True], symbols[1:] != symbols[:-1]])
            if not starts.all():
                first = np.flatnonzero(starts)
                sizes = np.diff(np.append(first, len(symbols)))
                made, long = symbols[first], sizes > 1
                made[long], unused = _renamed(made[long], sizes[long], unused)
                symbols = self._add(symbols, BLOCKS, starts, first, made)
                continue
            right = _mixed(symbols, seed)
            seed += 1
            rising = ~right[:-1] & right[1:]
            falling = right[:-1] & ~right[1:]
            merged = rising if rising.sum() >= falling.sum() else falling
            if not merged.any():
                continue
            starts = np.concatenate([[True], ~merged])
            first = np.flatnonzero(starts)
            made, at = symbols[first], np.append(merged, False)[first]
            made[at], unused = _renamed(symbols[first[at]], symbols[first[at] + 1], unused)
            symbols = self._add(symbols, PAIRS, starts, first, made)

    def _add(self, symbols: np.ndarray, kind: str, starts: np.ndarray, first: np.ndarray,
             made: np.ndarray) -> np.ndarray:
        self.levels.append(Level(np.append(symbols, -1), kind, np.append(np.cumsum(starts) - 1, len(first)),
                                 np.append(first, len(symbols))))
        return made

    def forward(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols from each place and from its other one on are equal; they differ."""
        return self._extended(one, two, 0) - one

    def backward(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols before each place and before its other one are equal."""
        return one - self._extended(one, two, 1)

    def _extended(self, one: np.ndarray, two: np.ndarray, back: int) -> np.ndarray:
        a, b = np.array(one, np.int64), np.array(two, np.int64)
        stopped = np.full(len(a), len(self.levels))
        climbing = np.arange(len(a))
        for height, level in enumerate(self.levels):
            x, y = a[climbing], b[climbing]
            inside = (level.first[level.above[x]] != x) | (level.first[level.above[y]] != y)
            at = np.flatnonzero(inside)
            ahead = np.ones(len(x), bool)
            x[at], y[at], ahead[at] = _one_step(level, x[at], y[at], back)
            a[climbing], b[climbing] = x, y
            stopped[climbing[~ahead]] = height
            climbing = climbing[ahead]
            a[climbing], b[climbing] = level.above[a[climbing]], level.above[b[climbing]]
        for height in range(len(self.levels) - 1, -1, -1):
            level, at = self.levels[height], np.flatnonzero(stopped > height)
            a[at], b[at], _ = _one_step(level, level.first[a[at]], level.first[b[at]], back)
        return a


def _one_step(level: Level, x: np.ndarray, y: np.ndarray, back: int):
    """Places after what is equal of one block or one symbol from there on, and whether more
    may be equal after it."""
    equal = level.symbols[x - back] == level.symbols[y - back]  # before the first place is the end mark
    if level.kind == PAIRS:
        step = equal.astype(np.int64)
        ahead = equal
    else:
        if back:
            rest_x, rest_y = x - level.first[level.above[x - 1]], y - level.first[level.above[y - 1]]
        else:
            last = len(level.first) - 1
            rest_x = level.first[np.minimum(level.above[x] + 1, last)] - x
            rest_y = level.first[np.minimum(level.above[y] + 1, last)] - y
        step = np.where(equal, np.minimum(rest_x, rest_y), 0)
        ahead = equal & (rest_x == rest_y)
    return (x - step, y - step, ahead) if back else (x + step, y + step, ahead)
