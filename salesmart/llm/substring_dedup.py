"""Substring dedup: windows of words that occurred before are removed, by super-k-mers.

Consecutive windows that share a minimiser (of three words) travel as one packed string to the
minimiser's bucket. There the windows of the distinct strings are sorted by a hash, equal hashes
are compared word by word, and all but the first occurrence of a window are spans to remove.

A task sends a string once, with its first place; further places in the same chunk are known to
repeat and travel as spans, dealt by document. So a passage with very many copies costs a row per
task in its bucket. See ``minimisers`` for buckets and frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm import minimisers as mz

GRAM = 3
CHUNK = 3 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _words(flat: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``flat``, which ends in white space: joined by single spaces, begin and end of
    each there, and the place of its end in ``flat``."""
    raw = np.frombuffer(flat, np.uint8)
    inside = ~SPACE[raw]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    norm, gap = raw[kept], ~inside[kept]
    norm[gap] = 32
    end = np.flatnonzero(gap)
    return norm.tobytes(), np.append(0, end + 1)[: len(end)], end, np.flatnonzero(kept & ~inside)


def _sent(found: dict, bucket: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    norm, begin, end = found["norm"], found["begin"].tolist(), found["end"].tolist()
    docs, number, start, words = found["docs"], found["number"], found["start"], found["words"]
    doc_list, start_list = number.tolist(), start.tolist()
    known: dict[bytes, int] = {}
    first, again = [], []
    # In order of places: rows of one document may interleave.
    for n in np.lexsort((start, number)).tolist():
        f = known.setdefault(norm[begin[n] : end[n]], n)
        if f == n:
            first.append(n)
        elif doc_list[f] != doc_list[n] or start_list[f] != start_list[n]:  # equal rows do not repeat each other
            again.append(n)
    rows = mz.span_rows(docs, number[again], start[again], start[again] + words[again], buckets) if again else []
    kept = np.array(first, np.int64)
    for b, at in mz.grouped(bucket[kept]):
        n = kept[at]
        strings = [norm[begin[x] : end[x]] for x in n.tolist()]
        lengths = np.array([len(s) for s in strings], np.int64)
        columns = [lengths, words[n], np.arange(len(n)), docs.ids[number[n]], docs.keys[number[n]], start[n]]
        rows.append((b, 0, mz.packed(columns, b"".join(strings))))
    return rows


def dedup_substrings(docs: DataFrame, width: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs`` (doc_id, text).

    A word goes if a window of ``width`` words covers it whose words also start earlier: in a
    smaller doc_id, or in the same document at an earlier word. ``kept`` is the other words,
    joined by single spaces. Windows are judged on the input.

    Null and empty texts have no words; texts of fewer words than ``width`` lose none; very long
    ones are read in overlapping pieces. A null doc_id is the smallest. Equal rows are one document and
    do not repeat each other. Different texts that share a doc_id, or have none, are documents of
    their own, in the order of their hashes. An empty table gives an empty result. Other columns are
    not read.
    """

    def cut(text: bytes) -> Iterator[tuple[int, bytes]]:
        words, step = text.split(), CHUNK // 16
        for at in range(0, max(1, len(words) - width + 1), step):
            yield at, b" ".join(words[at : at + step + width - 1])

    def prepare(chunk: mz.Chunk, cells: mz.Cells) -> dict:
        docs, number = mz.documents_of(chunk)
        base = np.array([p[2] for p in chunk], np.int64)
        sizes = np.array([len(p[3]) + 1 for p in chunk], np.int64)
        norm, begin, end, place = _words(b" ".join([*(p[3] for p in chunk), b""]))
        owner = np.searchsorted(np.cumsum(sizes) - 1, place)
        nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
        words = mz.hashes(mz.sums(np.frombuffer(norm, np.uint8)), begin, end)
        running = mz.sums(words)
        grams = mz.hashes_of_width(running, GRAM)
        first, last, at = mz.stretches(grams, owner, width, GRAM, cells)
        doc = owner[first]
        return {
            "norm": norm,
            "grams": grams,
            "owner": owner,
            "shape": (width, GRAM),
            "hash": grams[at],
            "key": mz.keys(grams[at], running, first, width, cells),
            "same": mz.hashes(running, first, last + width),
            "begin": begin[first],
            "end": end[last + width - 1],
            "bytes": end[last + width - 1] - begin[first],
            "docs": docs,
            "number": number[doc],
            "start": base[doc] + nth[first],
            "words": last - first + width,
        }

    def meet(table: pa.Table) -> pa.Table:
        id_, key, begin, end = mz.known_spans(table)
        strings, words, which, ids, keys, start = mz.strings_of(table)
        docs, (known, number) = mz.numbered((id_, key), (ids, keys))
        spans = [(known, begin, end)]
        if strings:
            # The first place of every string; at its other places all of it repeats.
            order = np.lexsort((start, number, which))
            which, number, start = which[order], number[order], start[order]
            head = np.append(True, which[1:] != which[:-1])
            first_doc, first_start = number[head], start[head]
            later = (number != first_doc[which]) | (start != first_start[which])
            spans.append((number[later], start[later], start[later] + words[which[later]]))
            spans.append(_repeated(strings, words, first_doc, first_start, width))
        return mz.spans_batch(docs, *mz.merged(*(np.concatenate(c) for c in zip(*spans))))

    rows = mz.identified(docs)
    spans = mz.repeated_spans(rows, CHUNK, cut, prepare, _sent, meet)
    return mz.without_spans(
        rows, spans, _cut, {"n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}
    )


def _repeated(strings: list[bytes], words: np.ndarray, docs: np.ndarray, starts: np.ndarray, width: int):
    """Spans of windows of distinct ``strings`` that have an earlier place in the bucket."""
    found = []
    for a, b in mz.parts(np.array([len(s) for s in strings])):
        norm = np.frombuffer(b" ".join([*strings[a:b], b""]), np.uint8)
        end = np.flatnonzero(norm == 32)
        begin = np.append(0, end + 1)[: len(end)]
        owner = np.repeat(np.arange(a, b, dtype=np.int32), words[a:b])
        whole = np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])
        hash_ = mz.hashes_of_width(mz.sums(mz.hashes(mz.sums(norm), begin, end)), width)[whole]
        head = np.searchsorted(owner, owner[whole])  # first word of the string
        at = begin[whole] - begin[head], end[whole + width - 1] - begin[head], whole - head
        found.append((hash_, owner[whole], *(x.astype(np.int32) for x in at)))
    hash_, owner, begin, end, nth = (np.concatenate(c) for c in zip(*found))
    window = mz.repeated(hash_)
    owner, begin, end = owner[window], begin[window].tolist(), end[window].tolist()
    doc, place = docs[owner], starts[owner] + nth[window]
    first: dict[bytes, tuple[int, int]] = {}
    out: list[tuple[int, int]] = []
    doc_list, place_list, owner_list = doc.tolist(), place.tolist(), owner.tolist()
    for n in np.lexsort((place, doc, hash_[window])).tolist():
        # Sorted by place within a hash: the first with these very words is the earliest.
        here = doc_list[n], place_list[n]
        if first.setdefault(strings[owner_list[n]][begin[n] : end[n]], here) != here:
            out.append(here)
    made = np.array(out, np.int64).reshape(-1, 2)
    return made[:, 0], made[:, 1], made[:, 1] + width


def _cut(text: bytes, spans: list[dict[str, int]]) -> tuple[int, int, str]:
    words = text.split()
    rest = words
    if spans:
        stay = np.ones(len(words), bool)
        for s in spans:
            stay[s["from"] : s["to"]] = False
        rest = [words[i] for i in np.flatnonzero(stay).tolist()]
    return len(words), len(words) - len(rest), b" ".join(rest).decode()
