"""Brute-force versions of the text operators, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {i: i + 32 for i in range(65, 91)}


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def substrings(docs, width=20):
    seen, out = {}, {}
    for doc, text in sorted(docs):
        words = WORD.findall(text or "")
        gone = bytearray(len(words))
        for i in range(len(words) - width + 1):
            if seen.setdefault(tuple(words[i : i + width]), (doc, i)) != (doc, i):
                gone[i : i + width] = b"\1" * width
        out[doc] = (len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g)))
    return out


def strings(docs, width=50):
    first, out = {}, {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first.setdefault(data[i : i + width], doc) < doc:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def lines(docs, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(SMALL)

    holders = {}
    for doc, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, set()).add(doc)
    out = {}
    for doc, text in docs:
        all_ = (text or "").split("\n")
        kept = [
            x for x in all_
            if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc
        ]
        out[doc] = (len(all_), len(all_) - len(kept), sha("\n".join(kept)))
    return out


def secrets(docs):
    kinds = (
        ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    )
    out = {}
    for doc, text in docs:
        spans, counts = [], []
        for rank, (kind, pattern, good) in enumerate(kinds):
            found = [m for m in re.finditer(pattern, text or "") if good(m)]
            counts.append(len(found))
            spans += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in found]
        out[doc] = (*counts, sha(",".join(s for *_, s in sorted(spans))))
    return out


def quality(docs):
    out = {}
    for doc, text in docs:
        text = text or ""
        words = WORD.findall(text)
        places = {}
        for i in range(len(words) - 2):
            places.setdefault(tuple(words[i : i + 3]), []).append(i)
        covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
        some = [x for x in text.split("\n") if WORD.search(x)]
        n = len(words)
        out[doc] = (
            n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(some) - len(set(some)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n,
        )
    return out


def pieces(docs, tokenizer, capacity=4096):
    out = {}
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out[doc, piece] = (at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    return out


def leaks(docs, items, window=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))

    grams = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(name)
    sizes = {len(g) for g in grams}
    out = {}
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    names |= grams[tuple(w[i : i + n])]
        listed = sorted(str(x) for x in names if x is not None)
        out[doc] = (len(w), len(hit), len(listed), sha(",".join(listed)), bool(hit))
    return out


def simhash(docs, width=4, max_bits=4):
    from xxhash import xxh64_intdigest

    prints = {}
    for doc, text in docs:
        w = WORD.findall((text or "").translate(SMALL))
        shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
        ones = [0] * 64
        for s in shingles:
            h = xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                ones[b] += h >> b & 1
        prints[doc] = sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))
    ids = sorted(prints)
    group = classes(np.array([prints[d] for d in ids], np.uint64), max_bits)
    return {d: (f"{prints[d]:016x}", ids[g]) for d, g in zip(ids, group)}


def classes(prints, max_bits):
    """Position of the first fingerprint that each one reaches by links."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= max_bits) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            parent[b] = a
    return [find(i) for i in range(len(prints))]


def urls(pages, parse, order=5, alphabet=256, hold_out=5, bins=20_000):
    """url -> (score, threshold) of the URLs that no rule decides; ``parse`` gives (host, path, rule, verdict)."""
    from xxhash import xxh64_intdigest

    def held(url):
        h = xxh64_intdigest(url.encode(), 42)
        return (h - 2**64 if h >= 2**63 else h) % hold_out == 0

    distinct = {u for u in pages if u}
    ruled = {u: parse(u)[3] for u in distinct}
    counts = {"allow": {}, "block": {}}
    for u in distinct:
        if ruled[u] and not held(u):
            for i in range(len(u)):
                for n in range(1, min(order, i + 1) + 1):
                    gram = u[i + 1 - n : i + 1]
                    counts[ruled[u]][gram] = counts[ruled[u]].get(gram, 0) + 1
    if not all(counts.values()):
        return {u: (0.0, 0.0) for u in distinct}
    totals = {}
    for kind, grams in counts.items():
        for gram, n in grams.items():
            total, types = totals.get((kind, gram[:-1]), (0, 0))
            totals[kind, gram[:-1]] = total + n, types + 1

    def likelihood(kind, window):
        p = 1 / alphabet
        for n in range(1, len(window) + 1):
            gram = window[-n:]
            total, types = totals.get((kind, gram[:-1]), (0, 0))
            if total:
                p = (counts[kind].get(gram, 0) + types * p) / (total + types)
        return np.log(p)

    def score(u):
        ends = [u[max(0, i + 1 - order) : i + 1] for i in range(len(u))]
        return sum(likelihood("allow", w) - likelihood("block", w) for w in ends) / len(u)

    kept = sorted((score(u), ruled[u]) for u in distinct if ruled[u] and held(u))
    threshold = 0.0
    if {r for _, r in kept} == {"allow", "block"}:
        step = (kept[-1][0] - kept[0][0]) / bins or 1.0
        groups = {}
        for s, r in kept:
            groups.setdefault(int((s - kept[0][0]) // step), []).append((s, r))
        good, bad = (sum(r == kind for _, r in kept) for kind in ("allow", "block"))
        best, before, passed = -1.0, None, {"allow": 0, "block": 0}
        for _, group in sorted(groups.items()):
            right = (good - passed["allow"]) / good + passed["block"] / bad
            if right > best:
                best, threshold = right, group[0][0] if before is None else (before + group[0][0]) / 2
            before = group[-1][0]
            for _, r in group:
                passed[r] += 1
    return {u: (score(u), threshold) for u in distinct if not ruled[u]}
