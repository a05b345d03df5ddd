"""What the text operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Run = Callable[[SparkSession, str], DataFrame]

# The six white-space characters that separate words, and the ASCII letters.
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

LEAST_ID = -(2**63)

# Texts can be long and a batch is held in memory, here and in the task's Python.
BATCH_BYTES = 1 << 20


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def texts(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column of ``docs`` can clash.

    A null doc_id counts as the smallest one, in ``_id``; the original stays in ``doc_id``. With
    ``whole`` all columns follow as the struct ``row``.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("_id"),
        F.col("text").cast("string").alias("text"),
        *whole_row(docs, whole),
    )


def whole_row(docs: DataFrame, whole: bool) -> list[Column]:
    return [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []


_SHIPPED: set[str] = set()


def python_tasks(spark: SparkSession) -> None:
    """Make ready for Python in tasks: bound the bytes of an Arrow batch, and send this package.

    The bound is one for all operators, so a frame that is run later meets the same. Executors get the package as an archive, so they need no copy of it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="salesmart-")) / "salesmart.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def committed(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """How many commits the store below ``root`` has, and what the last one says."""
    try:
        log = spark.read.schema("state string, commit long").parquet(f"{root}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    last = log.orderBy(F.desc("commit")).first()
    return (last.commit + 1, last.state) if last else (0, None)


def commit(spark: SparkSession, root: str, n: int, state: str = "") -> None:
    """Make commit ``n`` known; fails if another writer has made one of that number."""
    spark.createDataFrame([(state,)], "state string").coalesce(1).write.mode("error").parquet(f"{root}/commits/commit={n}")
