"""Byte-pair merging of many short segments at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


class Merges:
    """Pairs of symbols with a rank and the symbol they make.

    A segment is merged as byte-pair encoders do: the pair of least rank first, the leftmost of
    equals, one pair at a time. Segments of equal length take their steps together.
    """

    def __init__(self, pairs: Iterable[tuple[int, int, int, int]], symbols: int):
        """``pairs`` are left, right, rank, made; all symbols are below ``symbols``."""
        self.radix = symbols
        rows = sorted((a * symbols + b, rank, made) for a, b, rank, made in pairs)
        self.keys, self.ranks, self.made = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        self.none = int(self.ranks.max(initial=-1)) + 1

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol made, per pair; pairs that make none rank after all others."""
        if not len(self.keys):
            return np.full(left.shape, self.none), np.zeros(left.shape, np.int64)
        key = left * self.radix + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none), self.made[at]

    def merge_alike(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(rows, symbols)`` of segments of equal length (rows of ``symbols``): all merge their best
        pair at once, and leave when none is left."""
        rows = np.arange(len(symbols))
        rank, made = self.look(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if symbols.shape[1] == 1:
                yield rows, symbols
                return
            best = rank.argmin(axis=1)
            line = np.arange(len(rows))
            goes_on = rank[line, best] < self.none
            if not goes_on.all():
                yield rows[~goes_on], symbols[~goes_on]
                rows, symbols, rank, made, best = (x[goes_on] for x in (rows, symbols, rank, made, best))
                line = np.arange(len(rows))
                if not len(rows):
                    return
            symbols[line, best] = made[line, best]
            width = symbols.shape[1]
            keep = np.arange(width - 1)[None, :]
            symbols = np.take_along_axis(symbols, keep + (keep > best[:, None]), axis=1)
            if width == 2:
                continue
            keep = keep[:, : width - 2]
            # Pair i now starts at symbol i: those before the merge stay, those after it move up.
            order = keep + (keep >= best[:, None])
            rank, made = np.take_along_axis(rank, order, axis=1), np.take_along_axis(made, order, axis=1)
            for at, ok in ((best - 1, best > 0), (best, best < width - 2)):
                l, a = line[ok], at[ok]
                rank[l, a], made[l, a] = self.look(symbols[l, a], symbols[l, a + 1])

    def merge(self, flat: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Segments given as symbols in a row and their numbers: blocks of ``(segments, symbols)``."""
        starts, found = np.cumsum(size) - size, []
        for n in np.unique(size).tolist():
            alike = np.flatnonzero(size == n)
            for rows, merged in self.merge_alike(flat[starts[alike][:, None] + np.arange(n)]):
                found.append((alike[rows], merged))
        return found


def in_order(found: list[tuple[np.ndarray, ...]], n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Blocks of ``(segments, column, column, ...)`` as flat columns in the order of ``n`` segments, and
    the number of entries of each."""
    sizes = np.zeros(n, np.int32)
    for rows, first, *_ in found:
        sizes[rows] = first.shape[1]
    start = np.cumsum(sizes, dtype=np.int64) - sizes
    out = [np.empty(int(sizes.sum()), np.int32) for _ in range(len(found[0]) - 1 if found else 1)]
    for rows, *columns in found:
        at = start[rows][:, None] + np.arange(columns[0].shape[1])
        for flat, values in zip(out, columns):
            flat[at] = values
    return out, sizes
