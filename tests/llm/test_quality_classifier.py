"""The factorisation machine: its sums against all pairs, its gradients, its accuracy."""

import os
import sys
import zlib

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from salesmart.llm import quality_classifier as fm  # noqa: E402
from salesmart.llm import queries  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, quality int"


def machine(rng):
    return fm.Machine(
        np.zeros(fm.DENSE), np.ones(fm.DENSE), np.array([0.3]), rng.normal(0, 0.3, fm.SIZE), rng.normal(0, 0.3, (fm.SIZE, 3))
    )


def some_rows(rng, m, n=4):
    rows = [m.row(*fm.features(" ".join(f"w{rng.integers(30)}" for _ in range(9)), int(rng.integers(99)))) for _ in range(n)]
    return fm.Rows.join(rows), rows


def test_linear_time_sum_is_that_over_all_pairs():
    rng = np.random.default_rng(1)
    m = machine(rng)
    joined, rows = some_rows(rng, m)
    for logit, (at, value) in zip(m.sums(joined)[0], rows):
        want = m.bias[0] + m.weight[at] @ value
        for i in range(len(at)):
            for j in range(i + 1, len(at)):
                want += value[i] * value[j] * (m.factor[at[i]] @ m.factor[at[j]])
        assert abs(logit - want) < 1e-5


def test_gradients_against_finite_differences():
    rng = np.random.default_rng(2)
    m = machine(rng)
    joined, _ = some_rows(rng, m)
    label = np.array([0, 1, 1, 0])
    _, gradients = m.gradients(joined, label)
    used = joined.at[:5]
    places = [(m.bias, gradients[0], 0)] + [(m.weight, gradients[1], i) for i in used]
    places += [(m.factor, gradients[2], (i, f)) for i in used for f in range(3)]
    for p, g, i in places:
        old, loss = p[i], []
        for step in (1e-4, -1e-4):
            p[i] = old + step
            loss.append(m.gradients(joined, label)[0])
        p[i] = old
        assert abs((loss[0] - loss[1]) / 2e-4 - g[i]) < 1e-4


def test_words_in_one_bucket_are_added():
    at, value = fm.words_of(fm.Counter("a b b c c c".split()))
    want = {}
    for w, n in (("a", 1), ("b", 2), ("c", 3)):
        b = zlib.crc32(w.encode()) % fm.BUCKETS
        want[b] = want.get(b, 0) + np.log1p(n)
    norm = np.sqrt(sum(v * v for v in want.values()))
    assert dict(zip(at.tolist(), (value * norm).round(5).tolist())) == {b: round(v, 5) for b, v in want.items()}


def test_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learned = fm.learn(docs, labels)
    found = fm.score(docs, learned)
    said = found.join(labels, "doc_id").filter("held_out").groupBy("quality", "predicted").count().collect()
    right = sum(r["count"] for r in said if r.quality == r.predicted)
    assert right >= 0.97 * sum(r["count"] for r in said)
    ids = found.select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in ids)
    # Held-out labels, languages, sources and ids change no score.
    flipped = labels.withColumn("quality", F.when(fm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = fm.score(other, fm.learn(other, flipped))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "no id"), (None, None), (4, "same row"), (4, "same row"), (5, "shared id"), (5, "other"), (6, "word " * 300_000), (7, " \n\n")]
    docs = spark.createDataFrame([(i, t, None, None, None, 1.0, "r", 0) for i, t in rows], SCHEMA).repartition(3)
    labels = spark.createDataFrame(
        [(1, 0, "x"), (2, 0, "x"), (4, 1, "x"), (4, 1, "x"), (5, 1, "x"), (5, 0, "x"), (6, None, "x"), (None, 1, "x"), (99, 1, "x"), (7, 5, "x")],
        "doc_id long, quality int, text string",
    )
    learned = fm.learn(docs, labels)
    found = fm.score(docs, learned).collect()
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(map(repr, (i for i, _ in rows)))
    by_id = {}
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert by_id[1] == by_id[2] and len(set(by_id[4])) == 1
    assert len(fm.sample(docs, labels, 10)) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in (1, 2, 4))
    assert {r.score for r in fm.score(docs, fm.learn(docs, labels.limit(0))).collect()} == {0.5}
    assert fm.score(docs.limit(0), learned).count() == 0
    assert {r["row"].lang for r in fm.score(docs, learned, whole=True).collect()} == {None}


def test_registered_query(spark):
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert queries.QUERIES["op11_quality_classifier"](spark, SF_DIR).count() == n
