"""Daily files picked up as they arrive.

The stream only remembers which files were taken; each file is then loaded like any other, with
the same reader and the same checks. How it went is published with the version that the load makes:
the epoch, the file, its status and its counts. A micro-batch that is repeated after a failure finds
the files it was done with there and leaves them alone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from salesmart.plans.clean import CleanOptions, sale_day
from salesmart.plans.daily_load import Arrival, LoadRejected, daily_load, utc_now
from salesmart.plans.warehouse import Warehouse
from salesmart.sources.csv import BAD_RECORD, FILE_ORDER, WrongHeader, check_header, read_sales_csv

_FILES = "path string, modificationTime timestamp, length long, content binary"
_REFUSED = "path string, reason string, refused_at timestamp_ntz"

# What Spark says when a value breaks a strict rule; anything else that fails is not the file's fault.
_DATA_FAULTS = ("USER_RAISED_EXCEPTION",)


class NoValidDate(Exception):
    """No row of the file has a valid date, so it belongs to no day."""

    def __init__(self, metrics: dict[str, int]):
        super().__init__("no row has a valid date")
        self.metrics = metrics


def load_arrivals(
    spark: SparkSession,
    folder: str,
    warehouse_root: str,
    checkpoint: str,
    load_ts: datetime | None = None,
    options: CleanOptions = CleanOptions(),
    max_files: int | None = None,
    multiline: bool = False,
) -> StreamingQuery:
    """Load every file of ``folder`` not loaded yet, then stop. Schedule it as often as needed.

    A file that is refused does not hold up the others: it is listed, with the reason, below the
    warehouse in ``refused``, and counts as taken. ``Warehouse.loads`` lists all files taken, each
    with its counts: rows read, undated, malformed, filtered, replaced values, warnings, upserted.
    What is not the file's fault, such as another writer or a full disk, fails the run, and the next
    run goes on with the file.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def load(arrived: DataFrame, epoch: int) -> None:
        load_epoch(spark, warehouse_root, arrived, epoch, stream_id(spark, checkpoint), load_ts, options, multiline)

    return (
        reader.load(folder)
        .select("path", "modificationTime")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What names the stream over all its runs."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


def load_epoch(
    spark: SparkSession,
    warehouse_root: str,
    arrived: DataFrame,
    epoch: int,
    stream: str,
    load_ts: datetime | None = None,
    options: CleanOptions = CleanOptions(),
    multiline: bool = False,
) -> None:
    """Load the files of a micro-batch (path, modificationTime) that are not loaded by it yet."""
    warehouse = Warehouse(spark, warehouse_root)
    of_epoch = (F.col("stream") == stream) & (F.col("epoch") == epoch)
    done = {r.source for r in warehouse.loads().filter(of_epoch).select("source").collect()}
    # One row per file of the micro-batch; the contents are not read here.
    paths = [r.path for r in arrived.orderBy("modificationTime", "path").select("path").collect()]
    for path in paths:
        if path in done:
            continue
        when = load_ts or utc_now()
        arrival = Arrival(stream, epoch, path)
        try:
            _load(warehouse, path, when, options, multiline, arrival)
        except (LoadRejected, NoValidDate, WrongHeader, PySparkException) as error:
            if isinstance(error, PySparkException) and not _is_data_fault(error):
                raise
            manifest = warehouse.manifest()
            metrics = getattr(error, "metrics", {})
            record = arrival.load("REFUSED", metrics, when, str(error)[:2000])
            warehouse.publish(manifest.next(manifest.entries), record)
    refused = warehouse.loads().filter(of_epoch & (F.col("status") == "REFUSED"))
    listed = refused.select(F.col("source").alias("path"), "reason", F.col("loaded_at").alias("refused_at"))
    if not listed.isEmpty():
        # Written over if the epoch is repeated.
        listed.coalesce(1).write.mode("overwrite").parquet(f"{warehouse.root}/refused/stream={stream}/epoch={epoch}")


def _is_data_fault(error: PySparkException) -> bool:
    return any(fault in f"{error.getCondition()} {error}" for fault in _DATA_FAULTS)


def _load(
    warehouse: Warehouse, path: str, load_ts: datetime, options: CleanOptions, multiline: bool, arrival: Arrival
) -> None:
    check_header(warehouse.spark, path)
    rows = read_sales_csv(warehouse.spark, path, multiline)
    days, metrics = _days_of(rows, options)
    if not days and not metrics["bad_records"]:
        raise NoValidDate(metrics)
    # Malformed records refuse the load, whatever its days.
    daily_load(warehouse, rows, days or [date.min], load_ts, FILE_ORDER, options, arrival=arrival)


def _days_of(rows: DataFrame, options: CleanOptions) -> tuple[list[date], dict[str, int]]:
    """The days in a file, one value per day, and the counts of what has none."""
    bad = F.col(BAD_RECORD).isNotNull()
    per_day = rows.groupBy(F.when(~bad, sale_day(rows, options.date_formats)).alias("d")).agg(
        F.count("*").alias("n"), F.count_if(bad).alias("bad")
    )
    found = per_day.collect()
    undated = sum(r.n - r.bad for r in found if r.d is None)
    return (
        sorted(r.d for r in found if r.d is not None),
        {"read": sum(r.n for r in found), "bad_records": sum(r.bad for r in found), "bad_dates": undated},
    )
