"""Code lengths of prediction by partial matching, for tables of counted windows.

A window is a byte with the ``order`` bytes before it, packed into a number with
the byte lowest. The table of all windows with their counts is the context trie:
the children of a context are the windows that share it. All windows that end
in the same context of ``base`` bytes must be in one table, for they hold the
whole subtree; shorter contexts come from ``Roots``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALPHABET = 256


def context(keys: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes before the last one."""
    return (keys >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)


def tail(keys: np.ndarray, order: int) -> np.ndarray:
    """The last byte with its context of ``order`` bytes."""
    return keys & np.uint64((1 << (8 * (order + 1))) - 1)


def sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, values, minlength=len(found))


class Level:
    """Counts of one order with the sums of their contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys`` are sorted and different, ``counts`` above zero."""
        self.keys, self.counts = keys, counts
        self.contexts, self.of = np.unique(keys >> np.uint64(8), return_inverse=True)
        self.total = np.bincount(self.of, counts, minlength=len(self.contexts))
        self.kinds = np.bincount(self.of, minlength=len(self.contexts)).astype(float)

    def find(self, keys: np.ndarray) -> np.ndarray:
        return _find(self.keys, keys)

    def find_context(self, contexts: np.ndarray) -> np.ndarray:
        return _find(self.contexts, contexts)


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Roots:
    """Levels 0 to ``base - 1`` over all data: at most 256 ** base counts."""

    levels: list[Level]


def escape(total, kinds):
    """Mass of the escape and of one count, by method D: a kind gives up half a count."""
    return kinds / (2 * total), 1 / total


def code_lengths(keys: np.ndarray, counts: np.ndarray, order: int, roots: Roots) -> np.ndarray:
    """log10 probability of each different window's byte after its context.

    ``counts`` may be zero: such a window was asked for but never learned. On an
    escape to a shorter context, the symbols of the longer one are excluded.
    """
    base = len(roots.levels)
    levels = dict(enumerate(roots.levels))
    learned = counts > 0
    for k in range(order, base - 1, -1):
        found, n = sums_by(tail(keys[learned], k), counts[learned])
        levels[k] = Level(found, n)
    result, left = np.zeros(len(keys)), np.arange(len(keys))
    for k in range(order, -1, -1):
        level = levels[k]
        at = level.find_context(context(keys[left], k))
        seen = at >= 0
        # What the longer context has seen is excluded here: its counts and its kinds.
        total, kinds = np.zeros(len(left)), np.zeros(len(left))
        total[seen], kinds[seen] = level.total[at[seen]], level.kinds[at[seen]]
        if k < order:
            longer = levels[k + 1]
            if k + 1 not in excluded:
                here = level.find(tail(longer.keys, k))
                excluded[k + 1] = np.bincount(
                    longer.of, np.where(here >= 0, level.counts[here], 0),
                    minlength=len(longer.contexts))
            up = longer.find_context(context(keys[left], k + 1))
            known = up >= 0
            total[known] -= excluded[k + 1][up[known]]
            kinds[known] -= longer.kinds[up[known]]
        else:
            excluded = {}
        open_ = kinds > 0.5
        out, one = escape(np.maximum(total, 1), kinds)
        place = level.find(tail(keys[left], k))
        hit = (place >= 0) & open_
        result[left[hit]] += np.log10(level.counts[place[hit]] - 0.5) + np.log10(one[hit])
        miss = ~hit
        result[left[miss & open_]] += np.log10(out[miss & open_])
        left = left[miss]
        if not len(left):
            return result
    kinds = float(levels[0].kinds[0]) if len(levels[0].kinds) else 0.0
    result[left] -= np.log10(max(ALPHABET - kinds, 1.0))
    return result
