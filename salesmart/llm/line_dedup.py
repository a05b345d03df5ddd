"""Line dedup: lines repeated over many documents stay in one of them.

Frequent keys are counted over all documents. Then batches of documents, from the largest
doc_id down, meet the runs: a batch's keys are merge-anti-joined with each sorted run, the keys
that no run has become a run of their own, with the largest document of the batch as keeper,
and ``fanout`` runs of one level are merged into one of the next. Runs are disjoint by key, and
stored in buckets sorted by key, so neither a join with them nor their merging shuffles them.

Only 16-byte keys, document ids and places of lines are shuffled for this. The text moves once, to
meet the places of the lines that its document loses. Keys that stand in very many lines are dealt
over several tasks in every join.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from salesmart.llm.common import SPACES, commit, committed, lower_ascii, texts
from salesmart.session import materialise, scratch_path
from salesmart.sources.buckets import read_bucketed, write_bucketed

RUN = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("keeper", T.LongType())])
HEAVY = 1000
SALTS = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def key_hash(key: Column) -> Column:
    """The first 16 bytes of the key's SHA-256."""
    return F.unhex(F.left(F.sha2(key, 256), F.lit(32)))


class LineRuns:
    """Sorted runs of (key, keeper) in levels, below ``root`` in shared storage.

    Opened again, they are as the last ``add`` or ``compact`` left them. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, fanout: int = 4):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout
        self.commits, state = committed(spark, self.root)
        known = json.loads(state) if state else {"levels": [], "buckets": int(spark.conf.get("spark.sql.shuffle.partitions"))}
        self.levels: list[list[str]] = known["levels"]
        self.buckets: int = known["buckets"]

    def _write(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"level{level}/{uuid.uuid4().hex}"
        write_bucketed(run, f"{self.root}/{name}", "key", self.buckets)
        self.levels[level].append(name)

    def _commit(self) -> None:
        commit(self.spark, self.root, self.commits, json.dumps({"levels": self.levels, "buckets": self.buckets}))
        self.commits += 1

    def _read(self, name: str) -> DataFrame:
        return read_bucketed(self.spark, f"{self.root}/{name}", RUN, "key", self.buckets)

    def read(self) -> DataFrame | None:
        """All runs as one table, not known to be bucketed: a union of them would not reliably be."""
        paths = [f"{self.root}/{name}" for level in self.levels for name in level]
        return self.spark.read.schema(RUN).parquet(*paths) if paths else None

    def add(self, batch: DataFrame) -> None:
        """Add the keys of ``batch`` (key, keeper; unique) that no run has, as a new run."""
        fresh = batch.select("key", "keeper").repartition(self.buckets, "key")
        for level in self.levels:
            for name in level:
                fresh = fresh.join(self._read(name).select("key").hint("merge"), "key", "left_anti")
        self._write(0, fresh)
        self._commit()
        self.compact()

    def compact(self) -> None:
        """Merge every level that is full into one run of the next level."""
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                full, self.levels[level] = self.levels[level], []
                # Written as the rows lie; a row's bucket follows from its key, whoever writes it.
                self._write(level + 1, reduce(DataFrame.unionByName, map(self._read, full)))
                self._commit()


def salted(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """``rows`` with ``salt``: the rows of a heavy key are dealt over ``SALTS``."""
    marked = rows.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), "key", "left")
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64("_id", "_text"), F.lit(SALTS))).otherwise(0)
    return marked.withColumn("salt", salt.cast("int")).drop("_heavy")


def for_salts(keys: DataFrame, heavy: DataFrame) -> DataFrame:
    """One row per key, and one per salt of a heavy key."""
    marked = keys.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), "key", "left")
    salts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn("salt", F.explode(salts)).drop("_heavy")


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 3,
    whole: bool = False,
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for every row of ``docs`` (doc_id, text).

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose their lines everywhere but
    in the largest doc_id that has them; there all of them stay.

    Null and empty texts are one empty line. A null doc_id is the smallest. Rows with one
    doc_id are one document, and of those with different texts each loses its own lines. Repeated
    rows give a row each. A text's lines are picked by place, so a very long text with very many
    repeated lines costs in proportion. An empty table gives an empty result. Other columns are not
    read.
    """
    spark = docs.sparkSession
    row = ["row"] if whole else []
    source = texts(docs, whole).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_text", F.xxhash64("text"))
    # One row per long line.
    seen = materialise(
        source.select("_id", "_text", F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("at", "line"))
        .filter(F.length("line") >= min_chars)
        .select(key_hash(F.col("line")).alias("key"), "_id", "_text", "at"),
        "line-keys",
    )
    frequent = materialise(
        seen.groupBy("key", "_id").agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
        .filter(F.col("docs") >= min_docs),
        "line-frequent",
    )
    # Keys with more than one part in HEAVY of these lines: at most HEAVY of them.
    total = frequent.agg(F.sum("n")).first()[0] or 0
    heavy = frequent.filter(F.col("n") > total / HEAVY).select("key")
    found = materialise(
        salted(seen, heavy).join(for_salts(frequent.select("key"), heavy), ["key", "salt"], "left_semi"), "line-found"
    )

    runs = LineRuns(spark, scratch_path(spark, "line-runs"), fanout)
    cuts = found.agg(
        F.percentile_approx("_id", [i / batches for i in range(1, batches)], 1000)
    ).first()[0] or []
    edges = [None, *sorted(set(cuts), reverse=True), None]
    for above, below in zip(edges, edges[1:]):
        batch = found
        if above is not None:
            batch = batch.filter(F.col("_id") <= above)
        if below is not None:
            batch = batch.filter(F.col("_id") > below)
        # Written first: an anti join with it would be pushed below the aggregate, to all rows of a key.
        keepers = batch.groupBy("key").agg(F.max("_id").alias("keeper"))
        runs.add(materialise(keepers, "line-batch"))

    lost = (
        found.join(for_salts(runs.read(), heavy), ["key", "salt"])
        .filter(F.col("_id") < F.col("keeper"))
        .groupBy("_id", "_text")
        .agg(F.collect_set("at").alias("_lost"))
    )
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    return (
        source.join(lost, ["_id", "_text"], "left")
        .select("doc_id", *row, "text", "_lost", lines_of(F.col("text")).alias("_lines"))
        .select("doc_id", *row, "text", "_lost", "_lines", F.array_except(places, "_lost").alias("_stay"))
        .select(
            "doc_id",
            F.size("_lines").cast("long").alias("n_lines"),
            F.when(F.col("_lost").isNull(), 0).otherwise(F.size("_lost")).cast("long").alias("n_dropped"),
            F.when(F.col("_lost").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform("_stay", lambda at: F.get("_lines", at)), "\n"))
            .alias("kept"),
            *row,
        )
    )
