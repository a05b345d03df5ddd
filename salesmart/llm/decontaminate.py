"""Benchmark decontamination: a generalised suffix automaton of the benchmark's items.

The automaton recognises every run of words of any item. Documents stream through it; at each
word it knows the longest run of item words that ends there. A run of ``window`` words, or a whole
item that is shorter, hits its words. Spans of hit words are cut out of the text, and documents
with too large a part hit are rejected.

The benchmark is dealt into blocks of about ``block_words`` words (or one item). Every task gets
all blocks compressed, and goes through them for each of its chunks of documents; the automata of
``HELD`` blocks stay with a worker, further ones are built again for the next chunk. There is no
shuffle and one step in Python, whatever the number of blocks, up to ``TOGETHER`` compressed bytes;
a larger benchmark takes another step for each further ``TOGETHER``.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from salesmart.llm.common import python_tasks, whole_row

# Words are runs of letters a-z, digits and all characters beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


HELD = 3
CHUNK = 32 << 20
TOGETHER = 256 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences, with marks for windows and short items."""

    def __init__(self, items: Sequence[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, words in items:
            if words:
                sequence = [self.ids.setdefault(w, len(self.ids)) for w in words]
                sequences.append((name, sequence))
                last = 0
                for c in sequence:
                    last = self._extend(last, c)
        self.shortest = min([window, *(len(s) for _, s in sequences)])
        self._mark(sequences)

    def _state(self, length: int, link: int, transitions: dict[int, int]) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of state ``q`` that is reached from ``p`` as a state of its own."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier item has this run of words
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _mark(self, sequences: list[tuple[str | None, list[int]]]) -> None:
        # The state of a run's last `window` words is the ancestor whose lengths include it.
        self.anchor = list(range(len(self.length)))
        for s in sorted(range(len(self.length)), key=self.length.__getitem__):
            if s and self.length[self.link[s]] >= self.window:
                self.anchor[s] = self.anchor[self.link[s]]
        self.in_window: dict[int, set] = defaultdict(set)
        self.short: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for name, sequence in sequences:
            state = 0
            for at, c in enumerate(sequence):
                state = self.next[state][c]
                if at + 1 >= self.window:
                    self.in_window[self.anchor[state]].add(name)
            if len(sequence) < self.window:
                self.short[state][len(sequence)].add(name)

    def stream(self, ids: list[int]) -> Iterator[tuple[int, int, set]]:
        """(end, number of words, items) of the hits in ``ids``, for each word from left to right."""
        state, matched, window = 0, 0, self.window
        next_, link, length = self.next, self.link, self.length
        for at, c in enumerate(ids):
            while state and c not in next_[state]:
                state = link[state]
                matched = length[state]
            if c in next_[state]:
                state, matched = next_[state][c], matched + 1
            if matched >= window:
                yield at + 1, window, self.in_window[self.anchor[state]]
            if self.short:
                s = state
                while s > 0:
                    if s in self.short:
                        for n, names in self.short[s].items():
                            if n <= matched:
                                yield at + 1, n, names
                    s = link[s]


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"from": a, "to": b} for a, b in out]


def _search(automaton: Automaton, texts: list[str | None]) -> tuple[list[int], list[list], list[set]]:
    """Per text: number of words, spans of hit words, names of hitting items."""
    words = [words_of(t) for t in texts]
    spans: list[list] = [[] for _ in texts]
    names: list[set] = [set() for _ in texts]
    known = automaton.ids.get
    # A word that no item has ends every match: only stretches of known words are streamed.
    ids = np.array([x for ws in words for x in (*(known(w, -1) for w in ws), -1)] or [-1], np.int32)
    firsts = np.cumsum([0] + [len(ws) + 1 for ws in words])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
    begins, ends = edge[::2], edge[1::2]
    long = ends - begins >= automaton.shortest
    for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
        doc = int(np.searchsorted(firsts, begin, "right")) - 1
        base = begin - int(firsts[doc])
        for to, n, items in automaton.stream(ids[begin:end].tolist()):
            spans[doc].append((base + to - n, base + to))
            names[doc] |= items
    return [len(ws) for ws in words], spans, names


def blocks_of(benchmark: DataFrame, block_words: int) -> Iterator[bytes]:
    """The distinct items in compressed blocks; one block is on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    words = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1))
    size = items.agg(F.sum(words)).first()[0] or 0
    count = max(1, -(-2 * size // block_words) if size > block_words else 1)
    grouped = items.groupBy(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).alias("block")).agg(
        F.collect_list(F.struct("item_id", "text")).alias("items")
    )
    python_tasks(benchmark.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor().compress
        for batch in batches:
            blocks = [
                small(pickle.dumps([(x["item_id"], b" ".join(words_of(x["text"]))) for x in items])) for items in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["data"])

    for r in grouped.mapInArrow(pack, "data binary").toLocalIterator():
        yield bytes(r.data)


# The automata a worker has built last, by the file its block came in.
_BUILT: OrderedDict[tuple, Automaton] = OrderedDict()


def automaton_of(run: str, n: int, data: bytes, window: int) -> Automaton:
    key = run, n
    if key not in _BUILT:
        items = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        while len(_BUILT) >= HELD:
            _BUILT.popitem(last=False)
        _BUILT[key] = Automaton([(name, words.split()) for name, words in items], window)
    _BUILT.move_to_end(key)
    return _BUILT[key]


def chunks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    chunk: list[pa.RecordBatch] = []
    used = 0
    for batch in batches:
        chunk.append(batch)
        used += batch.nbytes
        if used >= size:
            yield chunk
            chunk, used = [], 0
    if chunk:
        yield chunk


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 100_000, whole: bool = False
) -> DataFrame:
    """``doc_id, text, n_words, spans, items`` for every row of ``docs`` (doc_id, text).

    ``spans``: stretches of hit words, counted from 0, end exclusive. ``items``: ids of the items
    (as text, sorted) of which a window occurs. Null and empty texts have no words; of a very long
    text every word is streamed. Items without words hit nothing; those without an id hit but are
    not named; repeated items are one. Rows are judged one by one, so repeated rows and null ids give
    a row each. An empty table gives an empty result, an empty benchmark no hits. Other columns are
    not read; with ``whole`` they follow as the struct ``row``.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<from:long,to:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
        *whole_row(docs, whole),
    )
    span_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def step(run: str, blocks: list):
        # With few blocks all automata stay built, and nothing is gained by larger chunks.
        size = CHUNK if len(blocks) > HELD else 1

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in chunks_of(batches, size):
                texts = [b.column(1).to_pylist() for b in chunk]
                spans = [b.column(3).to_pylist() for b in chunk]
                names = [b.column(4).to_pylist() for b in chunk]
                n_words: list = [None] * len(chunk)
                for n, block in enumerate(blocks):
                    automaton = automaton_of(run, n, block.value, window)
                    for i, some in enumerate(texts):
                        n_words[i], hits, hit_by = _search(automaton, some)
                        for row in (r for r, h in enumerate(hits) if h):
                            spans[i][row] = _merged(hits[row] + [(x["from"], x["to"]) for x in spans[i][row]])
                            names[i][row] = sorted(hit_by[row].union(names[i][row]) - {None})
                for i, batch in enumerate(chunk):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0),
                            batch.column(1),
                            pa.array(n_words[i], pa.int64()),
                            pa.array(spans[i], span_type),
                            pa.array(names[i], pa.list_(pa.string())),
                            *batch.columns[5:],
                        ],
                        names=batch.schema.names,
                    )

        return find

    together, used = [], 0
    for data in blocks_of(benchmark, block_words):
        if together and used + len(data) > TOGETHER:
            out = out.mapInArrow(step(uuid.uuid4().hex, together), out.schema)
            together, used = [], 0
        together.append(spark.sparkContext.broadcast(data))
        used += len(data)
    # An empty benchmark has no block; its step only counts words.
    together = together or [spark.sparkContext.broadcast(zstandard.ZstdCompressor().compress(pickle.dumps([])))]
    return out.mapInArrow(step(uuid.uuid4().hex, together), out.schema)


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])


def cut(text: str | None, spans: list[dict[str, int]]) -> str | None:
    """``text`` without the words of ``spans`` and what stands between them."""
    if not spans:
        return text
    words = list(WORD.finditer(text))
    out, at = [], 0
    for s in spans:
        out.append(text[at : words[s["from"]].start()])
        at = words[s["to"] - 1].end()
    return "".join([*out, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, whole: bool = False
) -> DataFrame:
    """``doc_id, text, cut, n_words, n_hit, items, rejected`` for every row of ``docs``.

    ``cut`` is the text without the hit spans; ``rejected`` says that more than ``max_coverage``
    of the words were hit. Rows, nulls and ``whole`` as in ``find_leaks``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [cut(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rest, pa.string())], names=[*batch.schema.names, "cut"]
            )

    found = find_leaks(docs, benchmark, window, whole=whole)
    found = found.mapInArrow(run, T.StructType([*found.schema.fields, T.StructField("cut", T.StringType())]))
    columns = ["doc_id", "text", "cut", "n_words", hit_words().alias("n_hit"), "items", *(["row"] if whole else [])]
    return found.select(*columns).select(
        "*", (F.col("n_hit") > max_coverage * F.col("n_words")).alias("rejected")
    )
