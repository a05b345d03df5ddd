"""What the steps of a load leave on disk."""

import glob
import os
import re
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from test_load import T1, T2, load, warehouse, write_csv  # noqa: F401  (a fixture)

from salesmart.plans.daily_load import LoadRejected, daily_load
from salesmart.queries import load as load_queries
from salesmart.schemas import RAW_NAMES, TABLES
from salesmart.session import scratch_path
from salesmart.sources.csv import FILE_ORDER, read_sales_csv

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")



def shuffles(spark):
    """The files of shuffles on this machine's disk."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return set(re.findall(r"shuffle_\d+", env.blockManager().diskBlockManager().getAllFiles().mkString(" ")))


def left(spark, before):
    """Shuffles that stay, as removed ones go a little later."""
    for _ in range(50):
        if shuffles(spark) <= before:
            return set()
        time.sleep(0.1)
    return shuffles(spark) - before


@pytest.fixture
def kept_shuffles(spark):
    """Spark's default, which ``shuffles_freed`` returns to."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(setting) == "false"
    yield
    assert spark.conf.get(setting) == "false"


def test_a_load_frees_its_shuffles(spark, warehouse, tmp_path, kept_shuffles):
    lines = [{"item_id": str(i), "sale_id": str(i // 3), "product_id": str(i % 7)} for i in range(60)]
    path = write_csv(tmp_path / "a.csv", lines)
    for ts in (T1, T2):
        before = shuffles(spark)
        result = load(warehouse, path, "20250616", ts)
        assert not left(spark, before)
    # What is read later shuffles anew.
    want = [(20250616, "SUCCESS", 60)]
    assert [[tuple(r) for r in result.days.collect()] for _ in range(2)] == [want, want]


def test_a_refused_load_frees_its_shuffles(spark, warehouse, tmp_path, kept_shuffles):
    path = write_csv(tmp_path / "a.csv", [{}, {"item_id": "2", "quantity": "0"}])
    before = shuffles(spark)
    with pytest.raises(LoadRejected):
        load(warehouse, path, "20250616")
    assert not left(spark, before)


def test_what_a_load_stores_is_compressed_and_of_the_sales_file_only(spark, warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{"item_id": "1"}, {"item_id": "2", "sale_id": "2"}])
    raw = read_sales_csv(spark, path).withColumn("helper", F.lit("not of the file"))
    daily_load(warehouse, raw, [date(2025, 6, 16)], T1, FILE_ORDER)
    (filtered,) = glob.glob(f"{warehouse.root}/staging/*/filtered")
    assert set(spark.read.parquet(filtered).columns) == {*RAW_NAMES, *FILE_ORDER, "date_id"}
    places = [filtered, *(f"{os.path.dirname(filtered)}/{name}" for name in TABLES), *(f"{warehouse.root}/{name}" for name in TABLES)]
    for place in [*places, f"{warehouse.root}/order_totals", f"{warehouse.root}/customer_emails"]:
        files = glob.glob(f"{place}/**/*.parquet", recursive=True)
        assert files and all(".zstd." in f for f in files), place


def test_the_sales_file_leaves_the_disk_after_the_loads(spark):
    place = f"{os.path.dirname(scratch_path(spark, 'x'))}/sales-file-*"
    before = set(glob.glob(place))
    frame = load_queries.full_load(spark, SF_DIR)
    (file,) = set(glob.glob(place)) - before
    kept = spark.read.parquet(file)
    assert set(RAW_NAMES) < set(kept.columns) and kept.count() == 0
    # The result is read from the published tables, as often as wanted.
    assert frame.count() == frame.count() > 0
