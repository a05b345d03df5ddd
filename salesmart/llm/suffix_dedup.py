"""Suffix-array dedup: bytes of repeated strings are removed, by prefix-free parsing.

Rolling-hash triggers cut the texts into phrases: a trigger is an 8-byte string whose rolling
hash is the smallest in some window of 50 bytes, so no phrase exceeds a window, and whether a
string is the trigger of a window follows from the window alone. Each phrase, up to and with its
trigger, goes to the bucket of that trigger together with what the parse has after it, as far as
a window reaches.

In a bucket the distinct phrases are the dictionary, and the distinct continuations are the parse. Two
suffix arrays are made: that of all suffixes of the dictionary, by prefix doubling, and the sorted
order of the parse with the lengths that neighbours share. A window is a suffix of a phrase and a
prefix of a continuation: sorted by the rank of the one and then by that of the other, windows stand
in corpus order, in which equal windows are neighbours, as the shared lengths say, and the smallest
doc_id of each class decides. Nothing is compared by hash alone.

A task sends a phrase with its continuation once, so highly repetitive text shrinks to its
dictionary before the shuffle; repeats inside a chunk travel as spans, dealt by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm import minimisers as mz
from salesmart.llm.arrays import smallest, sorted_with_shared, suffix_ranks

TRIGGER = 8
CHUNK = 3 << 20
TOGETHER = 40_000


def _sent(found: dict, bucket: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    flat, begin, end = found["flat"], found["begin"].tolist(), found["end"].tolist()
    known: dict[bytes, int] = {}
    of = np.array([known.setdefault(flat[a:b], n) for n, (a, b) in enumerate(zip(begin, end))], np.int64)
    docs, number, start, trigger = found["docs"], found["number"], found["start"], found["trigger"]
    # Rows are in order of documents: the first place of a string has the smallest one of the chunk.
    later = number > number[of]
    length = found["end"] - found["begin"]
    rows = mz.span_rows(docs, number[later], start[later], start[later] + length[later], buckets) if later.any() else []
    record = np.flatnonzero(~later)
    for b, at in mz.grouped(bucket[record]):
        n = record[at]
        strings, index = np.unique(of[n], return_inverse=True)
        text = b"".join([flat[begin[x] : end[x]] for x in strings.tolist()])
        columns = [length[strings], trigger[strings], index, docs.ids[number[n]], docs.keys[number[n]], start[n]]
        rows.append((b, 0, mz.packed(columns, text)))
    return rows


def dedup_strings(docs: DataFrame, width: int = 50) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs`` (doc_id, text).

    A byte of a text's UTF-8 form goes if a string of ``width`` bytes covers it that also starts
    in a document with a smaller doc_id. Strings do not cross documents and are judged on the
    input. ``kept`` (binary: a cut may split a character) is the other bytes, ``n_spans`` the
    number of removed runs.

    Null and empty texts have no bytes; texts shorter than ``width`` lose none; very long ones are
    read in overlapping pieces. A null doc_id is the smallest. Equal rows are one document and do not
    repeat each other. Different texts that share a doc_id, or have none, are documents of their own, in
    the order of their hashes. An empty table gives an empty result. Other columns are not read.
    """

    def cut(text: bytes) -> Iterator[tuple[int, bytes]]:
        for at in range(0, max(1, len(text) - width + 1), CHUNK):
            yield at, text[at : at + CHUNK + width - 1]

    def prepare(chunk: mz.Chunk, cells: mz.Cells) -> dict:
        docs, number = mz.documents_of(chunk)
        base = np.array([p[2] for p in chunk], np.int64)
        sizes = np.array([len(p[3]) for p in chunk], np.int64)
        flat = b"".join([p[3] for p in chunk])
        owner = np.repeat(np.arange(len(chunk), dtype=np.int32), sizes)
        running = mz.sums(np.frombuffer(flat, np.uint8))
        rolling = mz.hashes_of_width(running, TRIGGER)
        first, last, at = mz.stretches(rolling, owner, width, TRIGGER, cells)
        doc = owner[first]
        return {
            "flat": flat,
            "grams": rolling,
            "owner": owner,
            "shape": (width, TRIGGER),
            "hash": rolling[at],
            "key": mz.keys(rolling[at], running, first, width, cells),
            "same": mz.hashes(running, first, last + width),
            "begin": first,
            "end": last + width,
            "bytes": last + width - first,
            "docs": docs,
            "number": number[doc],
            "start": base[doc] + first - (np.cumsum(sizes) - sizes)[doc],
            "trigger": at + TRIGGER - first,
        }

    def meet(table: pa.Table) -> pa.Table:
        id_, key, begin, end = mz.known_spans(table)
        strings, trigger, which, ids, keys, start = mz.strings_of(table)
        docs, (known, number) = mz.numbered((id_, key), (ids, keys))
        spans = [(known, begin, end)]
        if strings:
            least = np.full(len(strings), np.iinfo(np.int64).max)
            np.minimum.at(least, which, number)
            length = np.array([len(s) for s in strings], np.int64)
            later = number > least[which]
            spans.append((number[later], start[later], start[later] + length[which[later]]))
            string, offset = corpus_repeats(strings, trigger, least, width)
            # What repeats a string of another document holds at all places of this string.
            places = np.flatnonzero(~later)
            places = places[np.argsort(which[places], kind="stable")]
            counts = np.bincount(which[places], minlength=len(strings))
            firsts = np.cumsum(counts) - counts
            repeat = counts[string]
            nth = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
            place = places[np.repeat(firsts[string], repeat) + nth]
            at = start[place] + np.repeat(offset, repeat)
            spans.append((number[place], at, at + width))
        return mz.spans_batch(docs, *mz.merged(*(np.concatenate(c) for c in zip(*spans))))

    # Windows dealt one by one took too much disk here, so hot triggers give way once (see README).
    rows = mz.identified(docs)
    spans = mz.repeated_spans(rows, CHUNK, cut, prepare, _sent, meet, passes=1)
    numbers = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64()}
    return mz.without_spans(rows, spans, _cut, {**numbers, "kept": pa.binary()})


def _maybe(strings: list[bytes], trigger: np.ndarray, width: int) -> np.ndarray:
    """Strings that can share a window: one half of the rest of a window stands on the same side
    of the trigger in another string too. Unequal hashes prove that they do not."""
    half = -(-(width - TRIGGER) // 2)
    length = np.array([len(s) for s in strings], np.int64)
    before, after = [], []
    for a, b in mz.parts(length):
        running = mz.sums(np.frombuffer(b"".join(strings[a:b]), np.uint8))
        size, cut = length[a:b], trigger[a:b]
        begin = np.cumsum(size) - size
        for out, from_, to in ((before, cut - TRIGGER - half, cut), (after, cut - TRIGGER, cut + half)):
            can = np.flatnonzero((from_ >= 0) & (to <= size))
            out.append((a + can, mz.hashes(running, (begin + from_)[can], (begin + to)[can])))
    found = np.zeros(len(strings), bool)
    for side in (before, after):
        at, hash_ = (np.concatenate(c) for c in zip(*side))
        found[at[mz.repeated(hash_)]] = True
    return np.flatnonzero(found)


def corpus_repeats(strings: list[bytes], trigger: np.ndarray, ids: np.ndarray, width: int):
    """String and offset of each window that a string with a smaller id has too.

    ``trigger``: end of each string's trigger. ``ids``: smallest document of each string.
    """
    some = _maybe(strings, trigger, width)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    ends = [strings[i][t - TRIGGER : t] for i, t in zip(some.tolist(), trigger[some].tolist())]
    order = sorted(range(len(some)), key=ends.__getitem__)
    at = 0
    while at < len(order):  # strings of one trigger stay together
        to = min(at + TOGETHER, len(order))
        while to < len(order) and ends[order[to]] == ends[order[to - 1]]:
            to += 1
        found.append(_repeats_among(strings, some[order[at:to]], trigger, ids, width))
        at = to
    string, offset = zip(*found)
    return np.concatenate(string), np.concatenate(offset)


def _numbers(strings: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct strings, and the number of each."""
    known: dict[bytes, int] = {}
    number = np.array([known.setdefault(s, len(known)) for s in strings], np.int64)
    return list(known), number


def _repeats_among(strings: list[bytes], some: np.ndarray, trigger: np.ndarray, ids: np.ndarray, width: int):
    cut = trigger[some].tolist()
    dictionary, phrase = _numbers([strings[i][:t] for i, t in zip(some.tolist(), cut)])
    suffix_rank, begin = suffix_ranks(dictionary, width)
    parse, shared = sorted_with_shared([strings[i][t:] for i, t in zip(some.tolist(), cut)], width - TRIGGER)

    windows = np.array([len(strings[i]) - width + 1 for i in some.tolist()], np.int64)
    row = np.repeat(np.arange(len(some)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    rank = suffix_rank[begin[phrase[row]] + offset]
    after = width - (trigger[some][row] - offset)  # bytes of the window in the parse
    order = np.argsort(rank * (len(shared) + 1) + parse[row], kind="stable")  # corpus order
    row, offset, rank, after = row[order], offset[order], rank[order], after[order]
    place = parse[row]
    # Neighbours with one suffix are equal if all places of the parse between them share enough.
    same = np.flatnonzero(rank[1:] == rank[:-1])
    moved = place[same + 1] > place[same]
    equal = np.ones(len(same), bool)
    equal[moved] = smallest(shared, place[same[moved]] + 1, place[same[moved] + 1] + 1) >= after[same[moved]]
    head = np.ones(len(row), bool)
    head[same[equal] + 1] = False
    owner = ids[some][row]
    least = np.minimum.reduceat(owner, np.flatnonzero(head))[np.cumsum(head) - 1]
    repeated = np.flatnonzero(least < owner)
    return some[row[repeated]], offset[repeated]


def _cut(text: bytes, spans: list[dict[str, int]]) -> tuple[int, int, int, bytes]:
    parts, at, runs = [], 0, _joined(spans, len(text))
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    rest = b"".join([*parts, text[at:]])
    return len(text), len(text) - len(rest), len(runs), rest


def _joined(spans: list[dict[str, int]], length: int) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["from"], min(s["to"], length)) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif a < b:
            out.append([a, b])
    return out
