"""Best-fit decreasing packing of tokenised documents into sequences.

Only the number of pieces per length decides a best-fit-decreasing packing, and there are at most
``capacity`` lengths. So the driver packs the histogram: a segment tree over remaining capacities
finds the tightest open sequences for a length, which take its pieces in bulk. The result is a
list of slots (length, first rank, first sequence, ...) whose size follows the capacity and not
the corpus. The executors number the pieces of each length, in salted groups with a prefix sum
over the salts, and look their rank up in the slots.

A recomputed task gives the same rows: ranks follow from the rows' own values.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from salesmart.llm.common import python_tasks
from salesmart.session import materialise

END = 1
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
REMEMBERED = 500_000
PUNCTUATION = ".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte but the line end: itself if it can be printed, else
    the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + n) for n, b in enumerate(hidden) if b != 10}


BYTE_LETTERS = _byte_letters()

# The steps of a tokenizer file for which a text's ids are those of its words.
BY_WORDS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class WordEncoder:
    """Token ids of texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and takes a text apart into letters, digits and the rest
    before it merges, so a text's ids are those of its words one after the other, and a word of
    letters with punctuation behind it is two parts. Words and letters seen before come from
    bounded memories; new letters go to the tokenizer's merges directly. A tokenizer file with other
    steps encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        self.by_words = all(steps.get(step) == wanted for step, wanted in BY_WORDS.items())
        self.words: dict[bytes, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.endings: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if not self.by_words:
            return self._ids([(t or b"").decode() for t in texts])
        # Each different word of a batch is looked up once; Arrow tells words apart and strings their ids together.
        parts = pc.ascii_split_whitespace(pa.array([t or b"" for t in texts], pa.binary()).view(pa.string()))
        coded = parts.flatten().dictionary_encode()
        words = _listed(coded.dictionary)
        if len(self.words) > REMEMBERED:
            self.words = {}
        found = list(map(self.words.get, words))
        if None in found:
            # Space around a text leaves empty words, which have no ids.
            self.words[b""] = b""
            self._learn([w for w, f in zip(words, found) if f is None and w])
            found = [self.words[w] if f is None else f for w, f in zip(words, found)]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)[parts.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]

    def forget(self) -> None:
        """Let go of what was learned: a worker outlives its task, and others need the memory."""
        self.words, self.letters, self.older = {}, {}, {}

    def _learn(self, fresh: list[bytes]) -> None:
        raw = b"\n".join(fresh).decode()
        # A capital sigma's small form depends on its place, and not for this tokenizer.
        whole = normalize("NFC", raw).lower().split("\n") if "\u03a3" not in raw else [""] * len(fresh)
        stems = [w.rstrip(PUNCTUATION) for w in whole]
        self._learn_letters({s for s in stems if s.isalpha()})
        odd, learned, words = [], self.letters.get, self.words
        for word, full, stem in zip(fresh, whole, stems):
            ids = learned(stem)
            if ids is None:
                odd.append(word)
            elif len(full) == len(stem):
                words[word] = ids
            else:
                ending = full[len(stem) :]
                if ending not in self.endings:
                    self.endings[ending] = self._ids([ending])[0]
                words[word] = ids + self.endings[ending]
        self.words.update(zip(odd, self._ids([w.decode() for w in odd])))

    def _learn_letters(self, wanted: set[str]) -> None:
        if len(self.letters) > REMEMBERED:
            self.letters, self.older = {}, self.letters
        known = wanted & self.older.keys()
        self.letters.update((w, self.older[w]) for w in known)
        new = list(wanted - known - self.letters.keys())
        # Letters in small form are what the tokenizer hands to its model, byte by byte.
        merge = self.tokenizer.model.tokenize
        plain = [w for w in new if w.isascii()]
        other = [w for w in new if not w.isascii()]
        spelled = "\n".join(other).encode().decode("latin-1").translate(BYTE_LETTERS).split("\n")
        for word, letters in zip([*plain, *other], [*plain, *spelled]):
            self.letters[word] = _as_bytes([token.id for token in merge(letters)])

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_as_bytes(f.ids) for f in found]


def _listed(words: pa.Array) -> list[bytes]:
    """``words``, which hold no line end, as a list: joined and split, since Arrow makes single values slowly."""
    if not len(words):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")
    return joined.view(pa.binary())[0].as_py().split(b"\n")


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _as_bytes(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text): ids, then the end mark, cut at ``capacity``.

    ``tokenizer`` is a file that every executor can read at that path.
    """
    python_tasks(docs.sparkSession)
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc, data in zip(ids, encode.encode(batch.column(1).cast(pa.binary()).to_pylist())):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row = (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        encode.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, PIECE + (", ids array<long>" if with_ids else "")
    )


class Tightest:
    """A segment tree over remaining capacities: which is the smallest one, of at least so much,
    that open sequences have?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = np.zeros(2 * self.leaves, bool)

    def mark(self, remaining: int, some: bool) -> None:
        node = self.leaves + remaining
        self.some[node] = some
        while node > 1:
            node //= 2
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def at_least(self, wanted: int) -> int | None:
        node = self.leaves + wanted
        if self.some[node]:
            return wanted
        while node > 1 and (node % 2 or not self.some[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.leaves


def plan(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Slots ``length, rank, sequence, offset, per_sequence`` of a best-fit-decreasing packing.

    A slot holds the pieces of ``length`` from ``rank`` on, ``per_sequence`` to a sequence.
    """
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)
    tree, slots, sequences = Tightest(capacity), [], 0

    def put(remaining: int, first: int, count: int) -> None:
        if remaining and count:
            open_[remaining].append((first, count))
            tree.mark(remaining, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.at_least(length)
            if remaining is None:
                remaining, first, count = capacity, sequences, -(-left // (capacity // length))
                sequences += count
            else:
                first, count = open_[remaining].pop()
                if not open_[remaining]:
                    tree.mark(remaining, False)
            # Once a sequence has taken a piece it is the tightest one, while it has room.
            each = remaining // length
            used = min(count, -(-left // each))
            placed = min(left, used * each)
            slots.append((length, rank, first, capacity - remaining, each))
            full, rest = divmod(placed, each)
            put(remaining - each * length, first, full)
            put(remaining - rest * length, first + full, 1 if rest else 0)
            put(remaining, first + used, count - used)
            rank, left = rank + placed, left - placed
    return np.array(sorted(slots), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text) with its ``sequence_id`` and ``offset``.

    Documents longer than ``capacity`` are cut into pieces of that length and a shorter last one.
    Null and empty texts are the end mark alone. Repeated rows and null ids are packed like any
    other row. An empty table gives an empty result. Other columns are not read.
    """
    pieces = materialise(token_pieces(docs, tokenizer, capacity), "pieces")
    salts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    # At most salts x capacity rows, whatever the number of pieces.
    groups = materialise(salted.groupBy("_salt", "length").agg(F.count("*").alias("n")), "piece-groups")
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(counts, capacity)

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("_salt", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_salt", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_nth", F.row_number().over(inside)).join(bases, ["_salt", "length"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = slots[:, 0] << 40 | slots[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            slot = slots[np.searchsorted(starts, length << 40 | rank, "right") - 1]
            nth = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:5]
                + [pa.array(slot[:, 2] + nth // slot[:, 4]), pa.array(slot[:, 3] + nth % slot[:, 4] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_base") + F.col("_nth") - 1).alias("_rank")
    ).mapInArrow(place, f"{PIECE}, sequence_id long, offset long")


def sequences(docs: DataFrame, tokenizer: str, capacity: int = 4096) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, each at most ``capacity`` ids."""
    keys = ["doc_id", "piece", "ids_crc32"]
    # Rows that are the same in all keys hold the same ids, so one of them serves all.
    ids = token_pieces(docs, tokenizer, capacity, with_ids=True).select(*keys, "ids").dropDuplicates(keys)
    placed = pack(docs, tokenizer, capacity).select(*[F.col(k).alias(f"_{k}") for k in keys], "sequence_id", "offset")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (
        placed.join(ids, same)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"))
    )
