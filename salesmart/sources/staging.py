"""Columnar staging between the steps of a run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from salesmart.functions.dates import date_key


def stage_raw(df: DataFrame, path: str, day: Column | None = None) -> str:
    """Write the raw frame as Parquet, replacing what a former attempt left at ``path``.

    The path should name the run, so that concurrent runs do not overwrite each other. With
    ``day`` the rows are partitioned by its date key, so that a daily slice reads one partition.
    """
    if day is None:
        df.write.mode("overwrite").parquet(path)
    else:
        keyed = df.withColumn("date_id", date_key(day)).hint("rebalance", "date_id")
        keyed.write.mode("overwrite").partitionBy("date_id").parquet(path)
    return path


def stage_filtered(df: DataFrame, path: str) -> str:
    """Write cleaned rows partitioned by ``date_id``; days not in ``df`` are left alone."""
    (
        # Balanced by day: small days are packed together and a large one is split over tasks.
        df.hint("rebalance", "date_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date_id")
        .parquet(path)
    )
    return path


def read_staged(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None
) -> DataFrame:
    """Staged rows; only the columns asked for are read.

    With ``days`` the staging is one partitioned by ``date_id``, and only these days are read.
    """
    if days is None:
        return spark.read.schema(schema).parquet(path)
    fields = [f for f in schema.fields if f.name != "date_id"]
    keyed = T.StructType([*fields, T.StructField("date_id", T.IntegerType())])
    wanted = ", ".join(d.strftime("%Y%m%d") for d in days)
    return spark.read.schema(keyed).parquet(path).filter(f"date_id IN ({wanted})")


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
