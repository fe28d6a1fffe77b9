"""A run-length grammar of a sequence by recompression, and longest common extensions on it.

Rounds alternate. Block compression replaces every run of one symbol by a symbol of its
own; pair compression deals the symbols to a left and a right class and replaces every
left symbol that a right one follows, with it, by a symbol of the pair. Both depend on
the symbols alone, so equal stretches are compressed alike but for their ends, and two
places are compared by climbing from level to level: at each at most a few symbols are
compared until both stand where the next level's symbols begin; after the first
difference the way down finds its exact place. All queries of a batch walk together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Level:
    """A level's symbols, and for the step to the next level the symbol that each falls into and where those begin."""

    symbols: np.ndarray
    up: np.ndarray
    first: np.ndarray
    is_block: bool


def left_class(symbols: np.ndarray, level: int) -> np.ndarray:
    """Which of the symbols are in the left class of a level: a fixed random half."""
    x = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((2 * level + 1) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(63)).astype(bool)


class Grammar:
    """The levels over a sequence of fewer than 2**29 numbers from 0 on, whose last one must occur only once.

    ``separators`` numbers that occur once each end the parts of a sequence: no extension crosses them,
    and the levels end when each part is about one symbol.
    """

    def __init__(self, symbols: np.ndarray, separators: int = 1):
        self.levels: list[Level] = []
        now, n = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1
        while len(now) > 2 * separators + 1:
            starts = np.ones(len(now), bool)
            if len(self.levels) % 2:
                # A pair's second symbol starts nothing.
                left = left_class(now, len(self.levels))
                second = left[:-1] & ~left[1:]
                starts[1:] = ~second
                first = np.flatnonzero(starts)
                size = np.diff(np.append(first, len(now)))
                compressed = size == 2
                keys = now[first[compressed]] * n + now[first[compressed] + 1]
            else:
                starts[1:] = now[1:] != now[:-1]
                first = np.flatnonzero(starts)
                size = np.diff(np.append(first, len(now)))
                compressed = size > 1
                keys = now[first[compressed]] * len(symbols) + size[compressed]
            self.levels.append(Level(now, np.cumsum(starts) - 1, np.append(first, len(now)), not len(self.levels) % 2))
            after = now[first]
            if len(keys):
                names = np.unique(keys, return_inverse=True)[1].reshape(-1)
                after[compressed] = n + names
                n += int(names.max()) + 1
            now = after
        self.top = now

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of different places the number of equal symbols from them on."""
        return self._common(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of different places the number of equal symbols before them; something must stand before the sequence that occurs once."""
        return self._common(a - 1, b - 1, -1)

    def _common(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        query, p, q = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        stopped: list[tuple[np.ndarray, ...]] = []
        for level in self.levels:
            in_p, in_q = level.up[p], level.up[q]
            if way > 0:
                inside = (level.first[in_p] != p) | (level.first[in_q] != q)
            else:
                inside = (level.first[in_p + 1] - 1 != p) | (level.first[in_q + 1] - 1 != q)
            equal = level.symbols[p] == level.symbols[q]
            step = inside & equal
            move = _move(level, p[step], q[step], in_p[step], in_q[step], way)
            p, q = p.copy(), q.copy()
            p[step] += way * move
            q[step] += way * move
            # After a step of unequal rests of blocks the next symbols differ, like those that differed at once.
            differs = inside & ~equal
            if level.is_block:
                differs[step] = level.symbols[p[step]] != level.symbols[q[step]]
                on_edge = _edge(level, p[step], way) & _edge(level, q[step], way)
                differs[step] &= ~on_edge
            stopped.append((query[differs], p[differs], q[differs]))
            on = ~differs
            query, p, q = query[on], level.up[p[on]], level.up[q[on]]
        end_query, end_p, end_q = [], [], []
        while len(query):
            same = self.top[p] == self.top[q]
            end_query.append(query[~same])
            end_p.append(p[~same])
            end_q.append(q[~same])
            query, p, q = query[same], p[same] + way, q[same] + way
        query, p, q = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (end_query, end_p, end_q))
        for level, found in zip(reversed(self.levels), reversed(stopped), strict=True):
            if way > 0:
                p, q = level.first[p], level.first[q]
            else:
                p, q = level.first[p + 1] - 1, level.first[q + 1] - 1
            equal = level.symbols[p] == level.symbols[q]
            move = _move(level, p[equal], q[equal], level.up[p[equal]], level.up[q[equal]], way)
            p[equal] += way * move
            q[equal] += way * move
            query, p, q = (np.concatenate(x) for x in zip((query, p, q), found, strict=True))
        common = np.empty(len(a), np.int64)
        common[query] = (p - a[query]) * way
        return common


def _edge(level: Level, p: np.ndarray, way: int) -> np.ndarray:
    own = level.up[p]
    return level.first[own] == p if way > 0 else level.first[own + 1] - 1 == p


def _move(level: Level, p: np.ndarray, q: np.ndarray, in_p: np.ndarray, in_q: np.ndarray, way: int) -> np.ndarray | int:
    """Symbols that equal ones at p and q have in common on the way: one, or what is left of the shorter block."""
    if not level.is_block:
        return 1
    if way > 0:
        return np.minimum(level.first[in_p + 1] - p, level.first[in_q + 1] - q)
    return np.minimum(p - level.first[in_p], q - level.first[in_q]) + 1
