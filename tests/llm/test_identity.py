"""Rows that share an id or have none: unrelated text stays whole, and one copy stays."""

import os
import sys

import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from salesmart.llm import substring_dedup, suffix_dedup  # noqa: E402
from salesmart.session import materialise  # noqa: E402

PASSAGE = " ".join(f"shared{i} passage{i * 7}" for i in range(30))
OTHER = " ".join(f"alone{i} clean{i * 3}" for i in range(60))


def plain(rows):
    """The rows as documents numbered in the order of id, null first, and hash of the text."""
    key = {r: (r[0] is not None, r[0] or 0, xxhash.xxh64(r[1].encode(), seed=42).intdigest()) for r in rows}
    signed = {r: (a, b, h - 2**64 if h >= 2**63 else h) for r, (a, b, h) in key.items()}
    order = {r: n for n, r in enumerate(sorted(set(rows), key=signed.get))}
    return order


@pytest.mark.parametrize("name", ["substrings", "strings"])
def test_spans_of_rows_with_shared_and_missing_ids(spark, name):
    rows = [
        (None, f"{PASSAGE} one"), (None, f"some more words before {PASSAGE}"), (None, OTHER), (None, OTHER),
        (5, f"x {PASSAGE}"), (5, OTHER + " of five"), (5, f"x {PASSAGE}"), (6, f"{OTHER[:700]} six {PASSAGE}"), (7, "own " + OTHER[40:]),
        (8, ""), (8, "short"),
    ]
    order = plain(rows)
    want = getattr(brute, name)([(n, r[1]) for r, n in order.items()])
    operator = {"substrings": substring_dedup.dedup_substrings, "strings": suffix_dedup.dedup_strings}[name]
    for parts in (1, 4):
        frame = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, _key string").repartition(parts)
        found = operator(frame).collect()
        have = sorted(((r.doc_id is None, r.doc_id or 0), *[x for x in r[1:-1]], brute.sha(bytes(r.kept) if name == "strings" else r.kept)) for r in found)
        assert have == sorted(((r[0] is None, r[0] or 0), *want[order[r]]) for r in rows)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(7, text, "a"), (7, text, "b"), (7, text, "c"), (8, text, "d")]
    rows += [(None, OTHER, c) for c in "efghi"] + [(3, PASSAGE, "j"), (3, PASSAGE.upper(), "k"), (None, PASSAGE, "l")]
    rows += [(20, None, "m"), (21, "", "n"), (30, "only one here", "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string").repartition(3)
    kept = materialise(corpus_pipeline.without_near_duplicates(spark, docs, ""), "kept").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 3), (False, 7), (False, 20), (False, 30), (True, 0)]
    assert docs.columns == ["doc_id", "text", "root"] == kept[0].__fields__
    assert corpus_pipeline.without_near_duplicates(spark, docs.limit(0), "").count() == 0
