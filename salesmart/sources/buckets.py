"""Parquet directories bucketed and sorted by a key, in Spark's own bucketed layout.

Rows of one key lie in the files of one bucket, so a join, an aggregate or a further bucketed write
by that key reads them without a shuffle. Spark keeps the layout of bucketed tables in a catalog.
Here it is known from elsewhere (a manifest, a parameter), so tables are declared over directories
for the session that reads them, and forgotten without touching a file.

Aggregate or join such tables by their key one by one, or declare several directories as partitions
of one table. Not over a union of them: Spark 4.1 takes a union of bucketed tables for bucketed, leaves
out the shuffle, and then may read the parts by size after all, so that rows of a key stay apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

# Partitions declared by one statement.
_TOGETHER = 500


def _name() -> str:
    return f"salesmart_{uuid.uuid4().hex}"


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_bucketed(
    frame: DataFrame, path: str, key: str, buckets: int, partition: str | None = None, mode: str = "error",
    compression: str | None = None,
) -> None:
    """Write ``frame`` below ``path``, in a directory per value of ``partition`` if given.

    Rows are not shuffled: tasks write a file for each bucket they hold rows of. A frame that is
    partitioned by the key into as many buckets, as a join with a bucketed table leaves it, gives
    one file per task, and others are best repartitioned by the key first.
    """
    name = _name()
    writer = frame.write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key).option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    if compression:
        writer = writer.option("compression", compression)
    try:
        writer.saveAsTable(name)
    finally:
        # An external table: its files stay.
        frame.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _declare(spark: SparkSession, schema: T.StructType, path: str, key: str, buckets: int, partition: str | None) -> str:
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY (`{partition}`) " if partition else ""
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {by}"
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION {_quoted(path)}"
    )
    return name


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The rows below ``path``, known to be bucketed by ``key``."""
    name = _declare(spark, schema, path, key, buckets, None)
    frame = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the frame has found its files
    return frame


class BucketedPartitions:
    """A table over directories of partitions, each written by ``write_bucketed``.

    Frames of it look their partitions up when they run, so the declaration lives until
    ``forget``.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int, partition: str,
        paths: Sequence[tuple[int, str]],
    ):
        self.spark = spark
        self.name = _declare(spark, schema, root, key, buckets, partition)
        for at in range(0, len(paths), _TOGETHER):
            places = " ".join(
                f"PARTITION (`{partition}` = {value}) LOCATION {_quoted(path)}" for value, path in paths[at : at + _TOGETHER]
            )
            spark.sql(f"ALTER TABLE {self.name} ADD {places}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
