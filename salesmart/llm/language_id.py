"""Language ID: a bidirectional gated recurrent network over bytes.

Two recurrent layers read a stretch of bytes from both ends; every position gets a label from
both states, and a document's probabilities are the mean over its positions. The network is
trained in numpy by backpropagation through time on stretches of a bounded, documented sample of
labelled documents: about ``sample_docs`` per language, chosen by a hash of the doc_id and text.

Every byte of every text is labelled. A text is cut into stretches of ``STRETCH`` bytes that run
side by side, so a long text costs no more per byte than a short one, and memory is bounded by
the number of stretches labelled at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesmart.llm.common import python_tasks, whole_row

STRETCH = 128
SIDE_BY_SIDE = 2048
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


@dataclass
class Layer:
    """One direction: input table (256 x 3H), recurrent weights (H x 3H). Gates: z, r, n."""

    table: np.ndarray
    weights: np.ndarray
    bias_n: np.ndarray

    @property
    def size(self) -> int:
        return len(self.weights)

    def forward(self, data: np.ndarray, keep: bool, mask: np.ndarray | None = None):
        """States after each of the bytes ``data`` (steps x rows); with ``keep``, all gates too.

        Where ``mask`` is 0 the state is 0, so that padding leaves no trace.
        """
        steps, rows, size = *data.shape, self.size
        state = np.zeros((rows, size), np.float32)
        states, saved = np.empty((steps, rows, size), np.float32), []
        for t in range(steps):
            x = self.table[data[t]]
            u = state @ self.weights
            zr = x[:, : 2 * size] + u[:, : 2 * size]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :size], zr[:, size:]
            inner = u[:, 2 * size :] + self.bias_n
            n = np.tanh(x[:, 2 * size :] + r * inner)
            if keep:
                saved.append((state, z, r, inner, n))
            state = n + z * (state - n)
            if mask is not None:
                state *= mask[t][:, None]
            states[t] = state
        return states, saved

    def backward(self, data: np.ndarray, saved: list, d_states: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, weights and bias by backpropagation through time."""
        size = self.size
        d_table, d_weights, d_bias = (np.zeros_like(a) for a in (self.table, self.weights, self.bias_n))
        d_state = np.zeros_like(d_states[0])
        for t in range(len(data) - 1, -1, -1):
            before, z, r, inner, n = saved[t]
            d = d_states[t] + d_state
            d_n = d * (1 - z) * (1 - n * n)
            d_z = d * (before - n) * z * (1 - z)
            d_r = d_n * inner * r * (1 - r)
            d_inner = d_n * r
            d_x = np.concatenate([d_z, d_r, d_n], axis=1)
            d_u = np.concatenate([d_z, d_r, d_inner], axis=1)
            np.add.at(d_table, data[t], d_x)
            d_weights += before.T @ d_u
            d_bias += d_inner.sum(0)
            d_state = d * z + d_u @ self.weights.T
        return [d_table, d_weights, d_bias]


@dataclass
class Network:
    languages: list[str]
    right: Layer
    left: Layer
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], size: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def some(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        def layer() -> Layer:
            return Layer(some(256, 3 * size, scale=0.3), some(size, 3 * size, scale=size**-0.5), np.zeros(size, np.float32))

        right, left = layer(), layer()
        return cls(languages, right, left, some(2 * size, len(languages), scale=0.3), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        sides = [a for s in (self.right, self.left) for a in (s.table, s.weights, s.bias_n)]
        return [*sides, self.out, self.bias]

    def labels(self, data: np.ndarray, mask: np.ndarray | None = None, keep: bool = False):
        """Probabilities of every position of ``data`` (steps x rows)."""
        ahead, saved = self.right.forward(data, keep, mask)
        behind, saved_back = self.left.forward(data[::-1], keep, None if mask is None else mask[::-1])
        behind = behind[::-1]
        size = self.right.size
        logits = ahead @ self.out[:size] + behind @ self.out[size:] + self.bias
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return (logits, ahead, saved, behind, saved_back) if keep else logits

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradients."""
        p, ahead, saved, behind, saved_back = self.labels(data, keep=True)
        rows = np.arange(data.shape[1])
        loss = float(-np.log(p[:, rows, label] + 1e-9).mean())
        p[:, rows, label] -= 1
        p /= data.size
        size = self.right.size
        both = np.concatenate([ahead, behind], axis=-1)
        d_out = np.tensordot(both, p, ([0, 1], [0, 1]))
        d_both = p @ self.out.T
        right = self.right.backward(data, saved, d_both[..., :size])
        left = self.left.backward(data[::-1], saved_back, d_both[::-1, :, size:])
        return loss, [*right, *left, d_out, p.sum((0, 1))]

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; no position, no probability."""
        sums = np.zeros((len(texts), len(self.languages)))
        lengths = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        firsts = np.cumsum(lengths) - lengths
        counts = -(-lengths // STRETCH)
        doc = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = firsts[doc] + nth * STRETCH
        size = np.minimum(STRETCH, lengths[doc] - nth * STRETCH)
        order = np.argsort(-size, kind="stable")  # whole stretches first: they need no mask
        for at in range(0, len(order), SIDE_BY_SIDE):
            part = order[at : at + SIDE_BY_SIDE]
            steps = int(size[part].max())
            places = np.arange(steps)[:, None]
            mask = None
            where = begin[part] + places
            if size[part[-1]] < steps:
                inside = places < size[part]
                mask, where = inside.astype(np.float32), np.where(inside, where, begin[part])
            p = self.labels(flat[where], mask)
            if mask is not None:
                p *= mask[..., None]
            np.add.at(sums, doc[part], p.sum(0))
        return sums / np.maximum(lengths, 1)[:, None]


def train(
    samples: list[tuple[bytes, str]], size: int = 10, steps: int = 350, rows: int = 192, length: int = 48, seed: int = 7
) -> Network | None:
    """A network for the languages of ``samples``; None without any sample of some length."""
    samples = sorted((t, label) for t, label in samples if len(t) >= 2)
    languages = sorted({label for _, label in samples})
    if not languages:
        return None
    network = Network.new(languages, size, seed)
    rng = np.random.default_rng(seed)
    by_language = [[np.frombuffer(t, np.uint8) for t, label in samples if label == language] for language in languages]
    parameters = network.parameters()
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    for step in range(1, steps + 1):
        label = rng.integers(len(languages), size=rows)
        data = np.empty((length, rows), np.uint8)
        for row, language in enumerate(label):
            texts = by_language[language]
            text = texts[rng.integers(len(texts))]
            data[:, row] = np.resize(text[rng.integers(max(1, len(text) - length + 1)) :], length)
        _, gradients = network.gradients(data, label)
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.02 * min(1.0, 1.5 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(parameters, gradients, first, second):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the doc_id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, sample_docs: int, sample_bytes: int) -> list[tuple[bytes, str]]:
    """About ``sample_docs`` labelled texts per language, and ``sample_bytes`` of each at most.

    The share of a language to take follows from its number of documents; a hash decides.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, sample_docs / n)])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    chosen = labelled.filter(draw < share[F.col("lang")])
    # The middle of a text says as much as its beginning, and boilerplate stands at the ends.
    piece = F.substring(F.col("text"), F.greatest(F.lit(1), F.length("text") / 2 - sample_bytes / 4).cast("int"), F.lit(sample_bytes // 2))
    # The draw leaves about sample_docs a language; the limit bounds it where many rows are equal.
    rows = chosen.select(piece.alias("text"), "lang", draw.alias("draw")).orderBy("draw", "lang", "text")
    rows = rows.limit(2 * sample_docs * len(counts)).collect()
    return [(r.text.encode(), r.lang) for r in rows]


def learn(docs: DataFrame, sample_docs: int = 250, sample_bytes: int = 2000) -> Network | None:
    """Train on ``docs`` (doc_id, text, lang): only rows with a language and not held out."""
    return train(sample(docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")), sample_docs, sample_bytes))


def predict(docs: DataFrame, network: Network | None, whole: bool = False) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (doc_id, text).

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or if there was
    nothing to learn from. Rows are judged one by one, so repeated rows and null ids give a row
    each; a null id is not held out. An empty table gives an empty result. Other columns are not
    read; with ``whole`` they follow as the struct ``row``.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            known = [net is not None and t is not None and LETTER.search(t) is not None for t in texts]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if any(known):
                p = net.documents([t.encode() if k else b"" for t, k in zip(texts, known)])
                best = p.argmax(1)
                for i in np.flatnonzero(known):
                    names[i], scores[i] = net.languages[best[i]], float(min(1.0, p[i, best[i]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), *batch.columns[2:]],
                names=["doc_id", "lang_pred", "score", *batch.schema.names[2:]],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *whole_row(docs, whole)
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            *rows.schema.fields[2:],
        ]
    )
    return rows.mapInArrow(run, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", *(["row"] if whole else [])
    )
