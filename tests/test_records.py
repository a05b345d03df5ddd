"""Quoted line breaks, read in splits: the same records as read by one task."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from salesmart.schemas import RAW_NAMES
from salesmart.sources import records
from salesmart.sources.csv import BAD_RECORD, FILE_ORDER, read_sales_csv
from salesmart.sources.records import WrongHeader


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def text_of(rows, end="\n"):
    out = io.StringIO()
    writer = csv.DictWriter(out, RAW_NAMES, restval="", lineterminator=end)
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue()


def by_one_task(spark, path):
    fields = ", ".join(f"{c} string" for c in [*RAW_NAMES, BAD_RECORD])
    options = dict(header=True, escape='"', multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_RECORD)
    return spark.read.schema(fields).options(**options).csv(path)


def rows():
    values = ["plain", "two\nlines", 'a "quoted", word', "\n\n", "ends\n", "é\nü" * 5, "x" * 700 + "\n" + "y" * 8000, '"', "", 'tail"\n"']
    return [{"item_id": str(i), "product_name": values[i % len(values)], "brand": values[(i * 7 + 3) % len(values)]} for i in range(200)]


def test_splits_give_the_records_of_one_task(spark, tmp_path, small_splits):
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n")):
        (tmp_path / name).write_bytes(text_of(rows(), end).encode())
    found = read_sales_csv(spark, str(tmp_path), multiline=True)
    columns = ["item_id", "product_name", "brand"]
    got = [tuple(r) for r in found.orderBy(*FILE_ORDER).select(*columns).collect()]
    want = sorted([tuple(r) for r in by_one_task(spark, str(tmp_path)).select(*columns).collect()], key=lambda r: int(r[0]))
    missing = lambda r: tuple(None if v == "" else v for v in r)
    assert sorted(got, key=lambda r: int(r[0])) == list(map(missing, want))
    assert [int(r[0]) for r in got] == [*range(200), *range(200)]  # in file order
    assert found.filter(F.col(BAD_RECORD).isNotNull()).count() == 0
    lines = records._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    assert len(records.begins_inside(lines)) > 5  # splits that begin inside a quoted value


def test_damaged_records_are_listed(spark, tmp_path, small_splits, monkeypatch):
    good = text_of(rows()[:20])
    (tmp_path / "open.csv").write_text(good + '1,"never closed' + "\nmore" * 2000)
    (tmp_path / "surplus.csv").write_text(good.rstrip("\n") + ',"sur\nplus"\n')
    found = read_sales_csv(spark, str(tmp_path), multiline=True)
    bad = {r["_file"][-8:]: r[BAD_RECORD] for r in found.filter(F.col(BAD_RECORD).isNotNull()).select("_file", BAD_RECORD).collect()}
    assert set(bad) == {"open.csv", "plus.csv"}
    assert bad["open.csv"].startswith('1,"never closed\nmore') and bad["open.csv"].endswith("more")
    assert found.filter(F.col(BAD_RECORD).isNull()).count() == 20 + 19


def test_a_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(text_of(rows()[:3]))
    (tmp_path / "b.csv").write_text("a,b\n1,2\n")
    with pytest.raises(WrongHeader):
        read_sales_csv(spark, str(tmp_path), multiline=True)


def test_long_records_hold_their_beginning():
    split = records._Split("f", 1, False)
    split._hold('"' + "x" * records.MAX_RECORD, 0)
    split._hold("y" * 10, 1)
    record, *_, too_long = split._record(False)
    assert too_long and len(record) <= records.MAX_RECORD + 2
