"""Records of a delimited text file whose quoted values hold line breaks, read in splits.

Whether a line of a split begins inside quotes follows from the number of quotes before it. A first
pass counts the quotes of every split, odd or even; sums over the splits of a file say how each one
begins. With that, every task finds the true starts of its records. What a split does not hold whole,
the end of one record and the beginning of another, is put together by file and order: two
fragments per split at most, a longer one through the splits in its middle.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from salesmart.session import materialise

# A quote that is never closed would make the rest of a file one record.
MAX_RECORD = 1 << 20
RECORDS = "record string, _file string, _block long, _line long, part int, closed boolean, too_long boolean"
WHOLE, BEGINS, CONTINUES, HEADER = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines with their place: file, split, and order within a task's splits."""
    return (
        spark.read.option("lineSep", "\n").text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
    )


def begins_inside(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin inside quotes: one entry per split at most."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("_file", "_block").agg((F.sum(quotes) % 2).alias("odd"))
    splits = splits.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    return {(r["_file"], r["_block"]) for r in splits.filter("inside").select("_file", "_block").collect()}


class WrongHeader(ValueError):
    """A file has other columns than expected."""


class _Split:
    """The records of one split, line by line of its batches."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.part = CONTINUES if inside else WHOLE
        self.held: list[str] = []  # lines of a record that is not closed yet
        self.size = 0
        self.line = -1
        self.first = block == 0  # the file's first record is to come

    def _hold(self, text: str, line: int) -> None:
        if not self.held:
            self.line = line
        if self.size <= MAX_RECORD:
            self.held.append(text[: MAX_RECORD + 1 - self.size])
        self.size += len(text) + 1

    def _record(self, closed: bool) -> tuple:
        part = self.part if self.part == CONTINUES or closed else BEGINS
        if self.first and part == WHOLE:
            part = HEADER
        self.first = False
        row = ("\n".join(self.held), self.file, self.block, self.line, part, closed, self.size > MAX_RECORD)
        self.held, self.size, self.part = [], 0, WHOLE
        return row

    def read(self, values: pa.Array, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        """The lines that are records by themselves, what they are, and the other records that end here."""
        odd = pc.fill_null(pc.count_substring(values, '"'), 0).to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.inside) % 2
        open_ = np.append([self.inside], after[:-1]).astype(bool)  # begins inside quotes
        alone = np.flatnonzero(~open_ & (after == 0))
        parts = np.full(len(alone), WHOLE, np.int32)
        if self.first and len(alone) and alone[0] == 0:
            parts[0], self.first = HEADER, False
        rows = []
        others = np.flatnonzero(open_ | (after != 0))
        if len(others):
            for at, text in zip(others.tolist(), values.take(pa.array(others)).to_pylist()):
                self._hold(text, int(lines[at]))
                if after[at] == 0:
                    rows.append(self._record(True))
        self.inside = bool(after[-1])
        return alone, parts, rows

    def finish(self) -> list[tuple]:
        return [self._record(False)] if self.held else []


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def quoted_records(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``record, _file, _block, _line, damaged`` for every record of the files at ``path``.

    Every file begins with a header of ``names``, or the scan is refused. A record is placed where it
    begins. ``damaged`` records are not closed at the end of their file, or longer than
    ``MAX_RECORD``, of which they hold the beginning. Lines end with a line feed, or a carriage
    return before it; blank lines are no records.
    """
    lines = _lines(spark, path)
    inside = spark.sparkContext.broadcast(begins_inside(lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: _Split | None = None
        for batch in batches:
            if not len(batch):
                continue
            blocks, order = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            files = batch.column(1)
            turn = (blocks[1:] != blocks[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(turn) + 1).tolist(), len(batch)]
            for begin, end in zip(edges, edges[1:]):
                file, block = files[begin].as_py(), int(blocks[begin])
                rows = []
                if split is None or (split.file, split.block) != (file, block):
                    rows = split.finish() if split else []
                    split = _Split(file, block, (file, block) in inside.value)
                alone, parts, more = split.read(batch.column(0)[begin:end], order[begin:end])
                rows += more
                if len(alone):
                    at = pa.array(alone + begin)
                    some = [c.take(at) for c in batch.columns]
                    n = len(alone)
                    yield pa.RecordBatch.from_arrays(
                        [*some, pa.array(parts), pa.array(np.ones(n, bool)), pa.array(np.zeros(n, bool))],
                        names=[c.split()[0] for c in RECORDS.split(", ")],
                    )
                if rows:
                    yield _batch(rows)
        if split and (rows := split.finish()):
            yield _batch(rows)

    # Stored once: fragments and whole records are read from there.
    found = materialise(lines.mapInArrow(run, RECORDS), "records")
    heads = found.filter(F.col("part") == HEADER).select("record").distinct()
    for head in heads.toLocalIterator():
        if not is_header(head.record, names):
            raise WrongHeader(f"{path} has other columns than expected: {head.record[:1000]}")
    whole = found.filter(F.col("part") == WHOLE).select("record", "_file", "_block", "_line", F.col("too_long").alias("damaged"))
    # Fragments in the order of a file: a record's beginning and all up to the next one's.
    in_file = Window.partitionBy("_file").orderBy("_block", "_line").rowsBetween(Window.unboundedPreceding, 0)
    in_record = Window.partitionBy("_file", "_n").orderBy("_block", "_line").rowsBetween(Window.unboundedPreceding, -1)
    pieces = found.filter(F.col("part").isin(BEGINS, CONTINUES)).withColumn("_n", F.sum((F.col("part") == BEGINS).cast("int")).over(in_file))
    # Of a record that is too long only the beginning is put together.
    wanted = F.coalesce(F.sum(F.length("record")).over(in_record), F.lit(0)) <= MAX_RECORD
    pieces = pieces.withColumn("_size", F.length("record")).withColumn("record", F.when(wanted, F.col("record")))
    joined = (
        pieces.groupBy("_file", "_n")
        .agg(
            F.sort_array(F.collect_list(F.struct("_block", "_line", "record"))).alias("p"),
            F.sum("_size").alias("size"),
            F.max("too_long").alias("too_long"),
            F.max("closed").alias("closed"),
        )
        .select(
            F.left(F.array_join(F.transform("p", lambda x: x["record"]), "\n"), F.lit(MAX_RECORD)).alias("record"),
            "_file",
            F.col("p")[0]["_block"].alias("_block"),
            F.col("p")[0]["_line"].alias("_line"),
            (F.col("too_long") | (F.col("size") > MAX_RECORD) | ~F.col("closed")).alias("damaged"),
        )
    )
    records = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.filter(F.length(F.trim("record")) > 0)


def is_header(record: str, names: Sequence[str]) -> bool:
    return [n.strip().lower() for n in next(csv.reader([record]), [])] == [n.lower() for n in names]
