"""Quality classifier: a factorisation machine over words, structure and metadata of documents.

Every feature has a weight and a short vector; a pair of features adds the product of their values
times the inner product of their vectors. The sum over all pairs is had in linear time, as half of
the square of the sum less the sum of the squares, factor by factor.

The features are all words of the whole text, hashed into ``BUCKETS``; statistics of its structure;
and the stored number of characters. The machine is trained in numpy on a bounded, documented sample
of labelled documents: at most ``sample_docs`` per label, those with the smallest hash of their id.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from salesmart.llm.common import python_tasks, whole_row
from salesmart.llm.language_id import held_out

BUCKETS = 1 << 14
# Classes of bytes whose shares are statistics: space, digit, upper, lower, other ASCII, beyond ASCII.
CLASS = np.array(
    [0 if c in b" \t\n\x0b\x0c\r" else 1 if chr(c).isdigit() else 2 if chr(c).isupper() else 3 if chr(c).islower() else 4 for c in range(128)]
    + [5] * 128
)
DENSE = 6 + 9
SIZE = BUCKETS + DENSE


def structure(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[float]:
    """What the form of a text and its metadata say, whatever its words."""
    data = np.frombuffer(text.encode(), np.uint8)
    shares = np.bincount(CLASS[data], minlength=6) / max(1, len(data))
    lines = text.split("\n")
    n = max(1, len(words))
    return [
        *shares,
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        np.log1p(len(words) / len(lines)),
        1 - len(set(lines)) / len(lines),
        0.0 if n_chars is None else np.log1p(max(0, n_chars)),
        1.0 if n_chars is None else 0.0,
    ]


def words_of(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the words: logarithms of their counts, as a vector of length 1."""
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    bucket = np.array([zlib.crc32(w.encode()) for w in counts], np.uint32) % BUCKETS
    value = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    at, place = np.unique(bucket, return_inverse=True)
    value = np.bincount(place, value)
    return at.astype(np.int32), (value / np.sqrt(value @ value)).astype(np.float32)


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    words = (text or "").split()
    counts = Counter(words)
    return *words_of(counts), structure(text or "", words, counts, n_chars)


@dataclass
class Rows:
    """Sparse rows one after the other: feature and value of each entry, and where rows begin."""

    at: np.ndarray
    value: np.ndarray
    first: np.ndarray

    @classmethod
    def join(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        lengths = np.array([len(at) for at, _ in rows])
        return cls(np.concatenate([at for at, _ in rows]), np.concatenate([v for _, v in rows]), np.cumsum(lengths) - lengths)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(self.at))))


@dataclass
class Machine:
    """``bias``, ``weight`` (features) and ``factor`` (features x factors); scales of the statistics."""

    mean: np.ndarray
    scale: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def row(self, at: np.ndarray, value: np.ndarray, dense: list[float]) -> tuple[np.ndarray, np.ndarray]:
        dense = np.clip((np.array(dense) - self.mean) / self.scale, -4, 4) / 4
        return np.append(at, np.arange(BUCKETS, SIZE)), np.append(value, dense).astype(np.float32)

    def sums(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit per row, the factors' sums per row, and each entry's share in them. No row is empty."""
        part = self.factor[rows.at] * rows.value[:, None]
        total = np.add.reduceat(part, rows.first)
        linear = np.add.reduceat(self.weight[rows.at] * rows.value, rows.first)
        pairs = (total * total - np.add.reduceat(part * part, rows.first)).sum(1) / 2
        return self.bias[0] + linear + pairs, total, part

    def scores(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(rows)[0], -30, 30).astype(float)))

    def gradients(self, rows: Rows, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean log-loss and its gradients."""
        logit, total, part = self.sums(rows)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        loss = float(-np.log(np.where(label == 1, p, 1 - p) + 1e-12).mean())
        error = (p - label) / len(label)
        row = rows.row_of()
        step = error[row] * rows.value
        weight = np.bincount(rows.at, step, len(self.weight))
        each = step[:, None] * (total[row] - part)
        factor = np.stack([np.bincount(rows.at, each[:, f], len(self.weight)) for f in range(each.shape[1])], axis=1)
        return loss, [np.array([error.sum()]), weight, factor]


def train(
    samples: list[tuple[np.ndarray, np.ndarray, list[float], int]], factors: int = 8, steps: int = 300, batch: int = 128, seed: int = 11
) -> Machine | None:
    """A machine for ``samples`` (buckets, values, statistics, label); None without any."""
    if not samples:
        return None
    rng = np.random.default_rng(seed)
    dense = np.array([s[2] for s in samples])
    machine = Machine(
        dense.mean(0), dense.std(0) + 1e-6, np.zeros(1), np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, factors)).astype(np.float32)
    )
    rows = [machine.row(*s[:3]) for s in samples]
    label = np.array([s[3] for s in samples])
    by_label = [np.flatnonzero(label == c) for c in np.unique(label)]
    parameters = [machine.bias, machine.weight, machine.factor]
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(members, batch // len(by_label)) for members in by_label])
        _, gradients = machine.gradients(Rows.join([rows[i] for i in chosen]), label[chosen])
        rate = 0.03 * (1 - step / (steps + 1))
        for p, g, m, v in zip(parameters, gradients, first, second):
            g = g + (1e-4 * p if p.size > 1 else 0)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    return machine


def sample(docs: DataFrame, labels: DataFrame, sample_docs: int) -> list[tuple[np.ndarray, np.ndarray, list[float], int]]:
    """Features and label of at most ``sample_docs`` documents per label, by the hash of their id.

    Ids with both labels teach nothing. Documents that share an id are drawn as one, the one whose
    text has the smallest hash.
    """
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    said = said.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    said = said.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).filter("quality = _most")
    draw = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for quality in (0, 1):
        some = said.filter(F.col("quality") == quality).select("doc_id", "quality").orderBy(*draw).limit(sample_docs)
        chosen = some if chosen is None else chosen.unionByName(some)
    spark = docs.sparkSession
    python_tasks(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, n) for t, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([at for at, _, _ in found], pa.list_(pa.int32())),
                    pa.array([value for _, value, _ in found], pa.list_(pa.float32())),
                    pa.array([dense for _, _, dense in found], pa.list_(pa.float64())),
                    batch.column(4),
                ],
                names=["doc_id", "quality", "at", "value", "dense", "draw"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    # At most 2 x sample_docs ids of 12 bytes.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text", "n_chars", F.xxhash64("text", "n_chars").alias("draw"))
    rows = rows.mapInArrow(run, "doc_id long, quality int, at array<int>, value array<float>, dense array<double>, draw long")
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct("at", "value", "dense", "quality"), "draw").alias("s"))
    found = one.orderBy("doc_id").limit(2 * sample_docs).select("s.*").toArrow()
    return [
        (np.array(r["at"], np.int32), np.array(r["value"], np.float32), r["dense"], r["quality"]) for r in found.to_pylist()
    ]


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = 1500) -> Machine | None:
    """Train on ``docs`` (doc_id, text, n_chars) with ``labels`` (doc_id, quality), held-out ids left out."""
    return train(sample(docs, labels, sample_docs))


def score(docs: DataFrame, machine: Machine | None, whole: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text, n_chars).

    A null text counts as an empty one, which is scored by its structure; of a very long one every
    word counts. Rows are judged one by one, so repeated rows and null ids give a row each; a null
    id is not held out. With nothing to learn from every score is 0.5. An empty table gives an empty
    result. Other columns are not read; with ``whole`` they follow as the struct ``row``.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    shared = spark.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = shared.value
        for batch in batches:
            scores = np.full(len(batch), 0.5)
            if fm is not None and len(batch):
                found = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
                scores = fm.scores(Rows.join([fm.row(*features(t, n)) for t, n in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), *batch.columns[3:]], names=["doc_id", "score", *batch.schema.names[3:]]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("n_chars").cast("long").alias("n_chars"),
        *whole_row(docs, whole),
    )
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), *rows.schema.fields[3:]])
    return rows.mapInArrow(run, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *(["row"] if whole else []),
    )
