"""The manifest and the prefix trie against brute force."""

import hashlib
import math
import os
import sys
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

sys.path.insert(0, os.path.dirname(__file__))

from compare import connect, difference  # noqa: E402

from salesmart.llm import conversation_trie, merkle, queries  # noqa: E402
from salesmart.llm.parens import Parens  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, idx long, node string"
TURNS = "conv_id long, turn long, role string, text string, key string, depth long, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(values))


def up(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def root_of(groups):
    """The root of ``groups`` (lists of leaves in the order of their languages)."""
    tops = []
    for nodes in [*groups, None]:
        nodes = tops if nodes is None else nodes
        while len(nodes) > 1:
            nodes = up(nodes)
        tops = [*tops, nodes[0]] if nodes is not tops else tops
    return nodes[0]


def manifest(rows):
    """doc_id, leaf -> (subroot, root, folded_root), every version built anew."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r))):
        groups.setdefault(row[2], []).append(row)
    trees = [[leaf_of(r) for r in g] for g in groups.values()]
    root, out = root_of(trees), []
    for g, members in enumerate(groups.values()):
        for i, row in enumerate(members):
            folded = root
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = None if row[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                changed = [list(t) for t in trees]
                changed[g][i] = leaf_of((row[0], text, *row[2:]))
                folded = root_of(changed)
            out.append((row[0], trees[g][i], root_of([trees[g]]), root, folded, folded == root))
    return out


def documents(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", 1, None) for r in rows], DOCS).repartition(parts)


def manifest_rows(frame):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.folded_root, r.verified) for r in frame.collect()]


def test_manifest_of_awkward_rows(spark):
    rows = [(i, f"Text {i} ÄB", "en", f"s{i % 3}", i) for i in range(75)]
    rows += [(i, "É" * i + "A", None, None, None) for i in range(9)]
    rows += [(200, None, "de", "s", 1), (5, "shared Id", "fr", "a", 2), (5, "another", "fr", "a", 2), (6, "x" * 300_000 + "Y", "fr", "", 0)]
    rows += [(7, "Same row", "es", "s", 3)] * 3 + [(None, "No id", "es", "s", 3), (None, None, None, None, None), (8, "", "", "", 0)]
    want = sorted(manifest(rows), key=repr)
    for levels in (1, 4):
        frame = merkle.manifest(documents(spark, rows), levels)
        assert sorted(manifest_rows(frame), key=repr) == want
    places = sorted((r.lang or "", r.idx) for r in frame.collect())
    assert len(set(places)) == len(rows) - 1  # the null language and the empty one share ""


def test_manifest_of_few_rows(spark):
    assert merkle.manifest(documents(spark, [])).count() == 0
    one = merkle.manifest(documents(spark, [(3, "Only", "en", None, None)])).collect()[0]
    assert one.leaf == one.subroot == one.root and one.proof == sha("") and one.verified == (one.folded_root == one.root)


def test_manifest_in_blocks_of_eight_is_that_of_sql(spark):
    found = merkle.manifest(spark.read.parquet(f"{SF_DIR}/documents.parquet"), 1).withColumnRenamed("proof", "proof_sha256")
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert difference(found.select(*columns), connect(SF_DIR), queries.SQL["op12_merkle_manifest"]) is None


def test_versions_share_all_but_the_path():
    leaves = [sha(str(i)) for i in range(100)]
    block = merkle.Block.build(leaves, len(leaves), 4)
    before = [list(level) for level in block.levels]
    version = block.put(70, sha("new"))
    changed = [*leaves[:70], sha("new"), *leaves[71:]]
    assert version.root == merkle.Block.build(changed, 100, 4).root != block.root
    assert block.levels == before and len(version.copied) == len(block.levels)
    assert version.node(1, 0, 70) is block.levels[1][0] and version.node(1, 8, 70) == version.copied[1]
    assert merkle.fold(leaves[70], *block.path(70)) == block.root


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=400))
def test_closing_places(ups):
    """Trees by the number of places to climb before each new node."""
    bits, depth = [1], 1
    for n in ups:
        close = min(n, depth - 1)
        bits += [0] * close + [1]
        depth += 1 - close
    bits += [0] * depth
    tree, stack, want = Parens(np.array(bits)), [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = tree.opens()
    assert opens.tolist() == sorted(want)
    assert tree.findclose(opens).tolist() == [want[i] for i in opens.tolist()]
    leaves = [sum(bits[j] and not bits[j + 1] for j in range(i, want[i])) for i in opens.tolist()]
    assert tree.leaf_pairs(opens, tree.findclose(opens)).tolist() == leaves


def test_closing_places_of_a_deep_tree():
    bits = np.array([1] * 5000 + [0] * 5000)
    assert Parens(bits).findclose(np.arange(5000)).tolist() == [9999 - i for i in range(5000)]


def trie(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            key = (role or "", text or "")
            size = f"{len((role or '').encode())}:{role or ''}{text or ''}"
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, key[0], sha(size), key))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - int(math.fmod(c, 100))  # as in SQL, the remainder has the sign of c
        seq = tuple(own.get(first, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            leaves[node], saved[node], sha(",".join(map(str, sorted(ends.get(node, []))))),
        )
        for node, convs in members.items()
    )


def trie_rows(spark, rows, shard_turns):
    frame = spark.createDataFrame([(*r, "k", 1, None) for r in rows], TURNS).repartition(4)
    return sorted(tuple(r) for r in conversation_trie.trie(frame, shard_turns).collect())


def plain(rows):
    return sorted(rows, key=lambda r: (r[1], r[0], r[2] is None, r))


def test_trie_of_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in [*range(0, 130), 1003, -5, -250]:
        for t in range(int(rng.integers(0, 9))):
            rows.append((c, t, ["user", "assistant", None][int(rng.integers(3))] if t else "user", "Hi é" if t < 2 else f"t{rng.integers(2)}"))
    rows += [(300 + c, t, "user", f"same {t}") for c in range(60) for t in range(8)]  # copies, more than a shard
    rows += [(500, None, None, None), (500, None, "a", ""), (500, 1, "a", "x"), (500, 1, "a", "x")]  # ties and repeats
    rows += [(None, 1, "user", "nobody"), (601, 0, "user", "long " * 50_000), (602, 0, "u", ":"), (602, 1, "u:", "")]
    rows += [(700, t, "user", f"deep {t}") for t in range(300)] + [(701, t, "user", f"deep {t}") for t in range(310)]
    assert zlib.crc32(b"805") % 6 > 0
    rows += [(805, 0, "user", "only turn, replaced by those of a conversation that is not there")]
    want = plain(trie(rows))
    for shard_turns in (1, 40, 1_000_000):
        assert plain(trie_rows(spark, rows, shard_turns)) == want


def test_trie_without_conversations(spark):
    assert trie_rows(spark, [], 10) == [] == trie_rows(spark, [(None, 1, "a", "b")], 10)
    assert trie_rows(spark, [(5, 0, "a", "b")], 10) == trie([(5, 0, "a", "b")])
