"""Small array algorithms of the text operators."""

from __future__ import annotations

import numpy as np


def smallest(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of ``values[first:end]`` for each pair, from minima of all stretches of 2**k."""
    out = np.empty(len(first), values.dtype)
    k_of = np.frexp((end - first).astype(float))[1] - 1
    level = values
    for k in range(int(k_of.max(initial=-1)) + 1):
        at = np.flatnonzero(k_of == k)
        out[at] = np.minimum(level[first[at]], level[end[at] - (1 << k)])
        level = np.minimum(level[: -(1 << k)], level[1 << k :])
    return out


def suffix_ranks(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes of ``strings`` by their first ``depth`` bytes, and where each string begins.

    Suffixes stand one after the other, string by string. A suffix ends with its string; equal ones
    have equal ranks, and a shorter one comes before those that it begins. By prefix doubling: the
    ranks by seven bytes come from the bytes, those by twice as many from pairs of ranks.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    symbol = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    left = np.repeat(begin + sizes, sizes) - np.arange(total)  # bytes from here to the string's end
    packed = np.zeros(total, np.int64)
    have = 7
    for i in range(have):
        packed <<= 9
        inside = np.flatnonzero(left > i)
        packed[inside] |= symbol[inside + i]
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
    while have < depth:
        step = min(have, depth - have)
        pair = (rank + 1) * (total + 1)
        inside = np.flatnonzero(left > step)
        pair[inside] += rank[inside + step] + 1
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank, begin


def sorted_with_shared(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each string in sorted order (equal ones share it), and how many bytes, ``depth``
    at most, each place's string shares with the one before."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    table = np.zeros((len(order), depth), np.int16)
    length = np.array([min(len(strings[i]), depth) for i in order], np.int64)
    table[np.arange(depth) < length[:, None]] = np.frombuffer(b"".join([strings[i][:depth] for i in order]), np.uint8).astype(np.int16) + 1
    same = table[1:] == table[:-1]
    shared = np.append(0, np.cumprod(same, axis=1, dtype=np.int8).sum(1)) if len(order) else np.zeros(0, np.int64)
    # Strings that differ beyond the depth only are one for all that is asked of them.
    new = np.append(True, ~same.all(1)) if len(order) else np.zeros(0, bool)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return place, shared[new].astype(np.int64)
