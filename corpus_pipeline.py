"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept and calls one operator on all of them.
Its result is written as Parquet to shared storage and read again, so a lost executor costs the
current stage at most.

All stages take null ids, null, empty and very long texts, repeated rows and columns of any name. An empty
table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.llm import decontaminate, language_id, line_dedup, packing, simhash
from salesmart.session import materialise

MIN_SCORE = 0.5

# SQL has no recurrent network, no rolling fingerprints by bits and no byte-pair encoding.
ORACLE_SQL = None


def with_text(columns: list[str], changed: Column, text: Column) -> list[Column]:
    """The columns of ``row`` with ``text`` and its length put in where it changed."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return [
        (F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c)
        for c in columns
    ]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language the network learned from these documents, by a clear margin.

    Rejected: texts that are null or have no letter, and those whose best language has under half
    of the probability.
    """
    labelled = language_id.predict(docs, language_id.learn(docs), whole=True)
    return labelled.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; no document goes."""
    found = line_dedup.dedup_lines(docs, whole=True)
    return found.select(*with_text(docs.columns, F.col("n_dropped") > 0, F.col("kept")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document, that with the smallest doc_id.

    A document without an id stays only if its whole group has none. Rows that repeat an id, or an
    id and its text, are members like others, so one row of the group stays in all.
    """
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly benchmark go."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), whole=True)
    return found.filter(~F.col("rejected")).select(*with_text(docs.columns, F.col("n_hit") > 0, F.col("cut")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("simhash_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
