"""A tree as balanced parentheses: one bit per opening and closing, children inside their parent.

The excess at a place is the number of parentheses open after it. Blocks of places keep their least
and greatest excess, and so do pairs of blocks, pairs of these, and so on: as the excess moves by one
at a time, a part of the sequence holds a value if and only if it lies between the two.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parens:
    def __init__(self, bits: np.ndarray):
        """``bits``: 1 opens, 0 closes; balanced, with one outermost pair."""
        self.bits = bits.astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        n = -(-len(bits) // BLOCK)
        low, high = np.full(n * BLOCK, len(bits)), np.full(n * BLOCK, -1)
        low[: len(bits)] = high[: len(bits)] = self.excess
        low, high = low.reshape(-1, BLOCK).min(1), high.reshape(-1, BLOCK).max(1)
        self.levels = [(low, high)]
        while len(low) > 1:
            if len(low) % 2:
                low, high = np.append(low, len(bits)), np.append(high, -1)
                self.levels[-1] = (low, high)
            low, high = low.reshape(-1, 2).min(1), high.reshape(-1, 2).max(1)
            self.levels.append((low, high))
        pairs = self.bits[:-1] & ~self.bits[1:]
        self.pairs = np.concatenate([[0], np.cumsum(pairs), [pairs.sum()]])

    def opens(self) -> np.ndarray:
        """The opening places, by rank."""
        return np.flatnonzero(self.bits)

    def leaf_pairs(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The number of ``()`` from a place to a later one, both included."""
        return self.pairs[last] - self.pairs[first]

    def _holds(self, level: int, node: np.ndarray, value: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        inside = node < len(low)
        node = np.minimum(node, len(low) - 1)
        return inside & (low[node] <= value) & (value <= high[node])

    def _scan(self, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place from ``at`` to the end of its block with the excess ``value``, or -1."""
        found = np.full(len(at), -1)
        active = np.arange(len(at))
        at = at.copy()
        while len(active):
            hit = self.excess[at[active]] == value[active]
            found[active[hit]] = at[active[hit]]
            active = active[~hit]
            at[active] += 1
            active = active[(at[active] % BLOCK != 0) & (at[active] < len(self.bits))]
        return found, at

    def findclose(self, opening: np.ndarray) -> np.ndarray:
        """The closing places of opening ones: where the excess first falls below its value there."""
        value = self.excess[opening] - 1
        # The rest of the opening's own block; an opening at a block's end starts with the next.
        start = opening + 1
        close = np.full(len(opening), -1)
        same = start % BLOCK != 0
        close[same], _ = self._scan(start[same], value[same])
        open_ = np.flatnonzero(close < 0)
        node, want = opening[open_] // BLOCK + 1, value[open_]
        # Up, until a part to the right holds the value.
        at_level = np.full(len(open_), -1)
        active = np.arange(len(open_))
        for level in range(len(self.levels)):
            here = self._holds(level, node[active], want[active])
            beside = ~here & (node[active] % 2 == 0) & self._holds(level, node[active] + 1, want[active])
            node[active[beside]] += 1
            at_level[active[here | beside]] = level
            active = active[~(here | beside)]
            node[active] = node[active] // 2 + 1
        # Down, to its first block that does.
        for level in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(at_level == level)
            left = self._holds(level - 1, 2 * node[down], want[down])
            node[down] = 2 * node[down] + ~left
            at_level[down] = level - 1
        close[open_], _ = self._scan(node * BLOCK, want)
        return close
