"""Whole queries and stages against brute force, and inputs at the edges of the operators' methods."""

import os
import re
import sys

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from salesmart.llm import decontaminate, line_dedup, packing, queries, secret_scan, simhash, url_filter  # noqa: E402
from salesmart.session import materialise, scratch_path  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def parse(url):
    """host, path, rule, verdict."""
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def check_urls(found, pages):
    want = brute.urls([u for _, u in pages], parse)
    by_page = {r.page_id: r for r in found}
    assert len(found) == len(pages)
    for page_id, url in pages:
        host, path, rule, verdict = parse(url)
        r = by_page[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict is None:
            score, threshold = want.get(url, (0.0, next(iter(want.values()), (0, 0.0))[1]))
            if abs(score - threshold) > 1e-9:
                verdict = "allow" if score >= threshold else "block"
        assert verdict in (None, r.verdict)


def test_urls_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = [tuple(r) for r in pages.collect()]
    check_urls(queries.QUERIES["op5_url_filter"](spark, "/root/testdata/sf0.01").collect(), rows)


def test_long_and_missing_urls_against_brute_force(spark):
    rng = np.random.default_rng(8)
    hosts = ["a.net", "b.org", "example.com", "x.example.net", "c.info"]
    paths = ["/en/good/page", "/fr/nice/text", "/de/bad/stuff", "/spam/casino"]
    rows = [(i, f"http://{hosts[rng.integers(5)]}{paths[rng.integers(4)]}/{rng.integers(99)}") for i in range(300)]
    rows += [(300, None), (301, ""), (302, "http://c.info/" + "long/" * 4000), (303, rows[0][1]), (304, "é://ü.org/fr/ß")]
    frame = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    check_urls(url_filter.filter_urls(frame).collect(), rows)
    ids = [r.page_id for r in url_filter.filter_urls(spark.createDataFrame([(None, rows[0][1]), (None, None)], frame.schema)).collect()]
    assert ids == [None, None]


def test_benchmark_of_many_blocks_is_one_step(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(100)] * 2
    docs = [(i, " ".join([*rng.choice(words, 30), *(items[i % 100][1].split() if i % 3 else [])])) for i in range(120)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), benchmark, block_words=40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    got = {r.doc_id: (r.n_words, sum(s["to"] - s["from"] for s in r.spans), len(r["items"])) for r in found.collect()}
    assert got == {d: w[:3] for d, w in brute.leaks(docs, items).items()}


@pytest.mark.parametrize("cell", [40, 300])
def test_members_of_a_large_cell_are_dealt_again(spark, cell):
    rng = np.random.default_rng(9)
    x = {(int(rng.integers(2**32)) << 32) | 0x12345678 for _ in range(1500)}  # one cell of a grid
    for centre in rng.integers(0, 2**63, 12).tolist():
        for _ in range(60):
            x.add(centre ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 7))}))
    x = np.array(sorted(x), np.uint64)
    rows = [(int(v),) for v in x.view(np.int64)]
    links = simhash.links(spark.createDataFrame(rows, "fingerprint long").repartition(4), 4, cell).collect()
    parent = {v: v for v in x.tolist()}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for r in links:
        a, b = (int(np.int64(v).astype(np.uint64)) for v in r)
        assert (a ^ b).bit_count() <= 4
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    group = brute.classes(x, 4)
    assert [find(v) for v in x.tolist()] == [int(x[g]) for g in group]


def test_stores_are_opened_again(spark):
    ledger = secret_scan.BlobLedger(spark, scratch_path(spark, "ledger"))
    ledger.scan(spark.createDataFrame([(1, "token=abcdef")], "path long, text string"))
    again = secret_scan.BlobLedger(spark, ledger.root)
    assert again.commits == 1 and [r.path for r in again.report().filter("found IS NOT NULL").collect()] == [1]
    again.scan(spark.createDataFrame([(2, "token=abcdef"), (3, "x")], "path long, text string"))
    assert spark.read.parquet(f"{ledger.root}/scanned/commit=1").select("blob").distinct().count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        ledger.scan(spark.createDataFrame([(4, "y")], "path long, text string"))  # a writer that missed a commit

    runs = line_dedup.LineRuns(spark, scratch_path(spark, "runs"), fanout=2)
    for batch in ([(1, 9), (2, 9)], [(2, 5), (3, 5)], [(4, 4)]):
        line_dedup.LineRuns(spark, runs.root, fanout=2).add(spark.createDataFrame([(bytes([k]), v) for k, v in batch], "key binary, keeper long"))
    found = line_dedup.LineRuns(spark, runs.root).read()
    assert sorted((bytes(r.key)[0], r.keeper) for r in found.collect()) == [(1, 9), (2, 9), (3, 5), (4, 4)]


def test_long_texts_with_many_lines_and_secrets(spark):
    line = "a frequent line of the licence number {}, as long as it takes"
    rows = [(i, "\n".join(line.format(n) for n in range(i, 3000))) for i in range(6)] + [(9, " ".join(f"token=abcdef{n}" for n in range(5000)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_lines, r.n_dropped, brute.sha(r.kept)) for r in line_dedup.dedup_lines(frame).collect()}
    assert got == brute.lines(rows)
    spans = secret_scan.digest(secret_scan.scan_documents(frame, scratch_path(spark, "ledger"))).collect()
    want = brute.secrets(rows)
    assert {r.doc_id: tuple(r)[1:5] for r in spans} == {d: tuple(w)[:4] for d, w in want.items()}


def test_another_tokenizer_encodes_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Hello World, it's Ünï 12  ok.\n"
    encoder = packing.WordEncoder(path)
    assert not encoder.by_words and packing.WordEncoder(WORD_BPE).by_words
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == ids


def test_rows_without_an_id_in_packing_leaks_and_language(spark):
    from salesmart.llm import language_id

    rows = [(None, "one text of words"), (None, "one text of words"), (None, None), (3, "another text"), (3, "another text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    tokens = Tokenizer.from_file(WORD_BPE)
    want = sorted(len(tokens.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sorted(r.length for r in packing.pack(frame, WORD_BPE).collect()) == want
    benchmark = spark.createDataFrame([(1, "text of words")], "item_id long, text string")
    leaks = decontaminate.find_leaks(frame, benchmark).collect()
    assert sorted((r.doc_id or 0, r.n_words, len(r.spans)) for r in leaks) == [(0, 0, 0), (0, 4, 1), (0, 4, 1), (3, 2, 0), (3, 2, 0)]
    said = language_id.predict(frame, None).collect()
    assert sorted((r.doc_id or 0, r.held_out, r.lang_pred, r.score) for r in said) == [(0, False, "und", 0.0)] * 3 + [(3, said[-1].held_out if said[-1].doc_id else [r for r in said if r.doc_id][0].held_out, "und", 0.0)] * 2


def test_stages_of_the_pipeline_against_brute_force(spark):
    """Each stage on what the one before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]

    def texts(frame):
        return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}

    stages = dict(corpus_pipeline.STAGES)

    def after(name, frame):
        out = materialise(stages[name](spark, frame, SF_DIR), name)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        return out

    labelled = {r.doc_id for r in docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id").collect()}
    known = after("language_id", docs)
    kept = texts(known)
    assert len(labelled & kept.keys()) >= 0.97 * len(labelled)
    assert all(texts(docs)[d] == t and re.search(r"[^\W\d_]", t) for d, t in kept.items())

    lines = after("line_dedup", known)
    assert {d: brute.sha(t) for d, t in texts(lines).items()} == {d: w[2] for d, w in brute.lines(kept.items()).items()}

    before = texts(lines)
    single = after("simhash_dedup", lines)
    assert texts(single) == {d: before[d] for d, (_, least) in brute.simhash(before.items()).items() if d == least}

    before = texts(single)
    clean = after("decontamination", single)
    leaks = brute.leaks(before.items(), items)
    left = texts(clean)
    assert left.keys() == {d for d, w in leaks.items() if 2 * w[1] <= w[0]}
    for d, t in left.items():
        n_words, n_hit = leaks[d][:2]
        assert brute.leaks([(d, t)], [])[d][0] == n_words - n_hit
        assert n_hit or t == before[d]
    assert all(r.n_chars == len(r.text) for r in clean.select("text", "n_chars").collect() if r.text != before.get(r.text))

    pieces = after("best_fit_packing", clean).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in pieces} == brute.pieces(left.items(), Tokenizer.from_file(WORD_BPE))
    end = {}
    for r in sorted(pieces, key=lambda r: r.offset):
        assert end.get(r.sequence_id, 0) == r.offset
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 4096
    whole = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert whole == {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in pieces}
