"""Session settings and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("salesmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a session of one machine (tests)
    gets a temporary folder of its own; on a cluster that folder would not be shared, so there
    the job is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="salesmart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/salesmart/{name}-{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside remove their shuffle files as they end.

    Spark else keeps them until the driver's JVM has collected their plans, so that a run of many steps
    holds the shuffles of all of them on disk. For steps whose result is stored: a frame made inside
    and run twice shuffles twice.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialise(df, name: str):
    """Write ``df`` to the shared scratch area and read it back.

    Cuts the lineage so that several passes do not recompute ``df``; the copy lies on shared
    storage and outlives a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df, name: str, compression: str) -> Iterator:
    """``materialise`` for the steps inside: its rows leave the disk with the last of them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
