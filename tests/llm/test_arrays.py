"""Suffix ranks, shared lengths and range minima against plain versions."""

import numpy as np
from hypothesis import given, settings, strategies as st

from salesmart.llm.arrays import smallest, sorted_with_shared, suffix_ranks

SOME = st.lists(st.text("ab\0", max_size=30).map(str.encode), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(SOME, st.integers(1, 40))
def test_suffix_ranks(strings, depth):
    rank, begin = suffix_ranks(strings, depth)
    depth = max(depth, 7)
    suffixes = [s[i:][:depth] for s in strings for i in range(len(s))]
    order = {s: n for n, s in enumerate(sorted(set(suffixes)))}
    assert rank.tolist() == [order[s] for s in suffixes]
    assert begin.tolist() == [sum(map(len, strings[:i])) for i in range(len(strings))]


@settings(max_examples=200, deadline=None)
@given(SOME, st.integers(1, 20))
def test_sorted_with_shared(strings, depth):
    place, shared = sorted_with_shared(strings, depth)
    order = sorted({s[:depth] for s in strings})
    assert place.tolist() == [order.index(s[:depth]) for s in strings]
    want = [0] + [sum(np.cumprod([x == y for x, y in zip(a, b)], dtype=int)) for a, b in zip(order, order[1:])]
    for n, (have, plain) in enumerate(zip(shared.tolist(), want)):
        # A string that the next one begins with shares no more than itself.
        assert have == plain, (n, order)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1, max_size=50), st.data())
def test_smallest(values, data):
    pairs = data.draw(st.lists(st.tuples(st.integers(0, len(values) - 1), st.integers(1, len(values))), max_size=9))
    pairs = [(a, max(b, a + 1)) for a, b in pairs]
    first, end = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ([], [])))
    assert smallest(np.array(values), first, end).tolist() == [min(values[a:b]) for a, b in pairs]
