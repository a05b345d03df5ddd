"""What is shuffled, and how rows are dealt to tasks."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from salesmart import schemas
from salesmart.operators import dedup, duplicates
from salesmart.plans import entities, views
from salesmart.queries import quality
from salesmart.sources import testtables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def shuffled(spark):
    """Nothing is broadcast unasked, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def explained(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanged(df):
    """The columns of every shuffle."""
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", explained(df))


@pytest.mark.parametrize("by, texts", [("sale_id", ["c_name", "n_name"]), ("product_id", ["p_name", "p_type"])])
def test_lines_are_shuffled_without_the_texts_joined_last(shuffled, by, texts):
    lines = [columns for columns in exchanged(testtables.flat_sales(shuffled, SF_DIR, by)) if "l_orderkey#" in columns]
    assert len(lines) == 2
    assert not [columns for columns in lines if any(f"{text}#" in columns for text in texts)]


def test_products_of_rows_by_product_are_not_shuffled_with_all_rows(shuffled):
    frame = entry_points.queries()["upsert_products"](shuffled, SF_DIR)
    assert "lineitem" not in explained(frame)


def test_large_tables_come_in_parts_of_bounded_size(shuffled, monkeypatch):
    n_lines = testtables.table(shuffled, SF_DIR, "lineitem").count()
    monkeypatch.setattr(testtables, "TASK_LINES", 200)
    rows = testtables.dirty_sales(shuffled, SF_DIR).select("item_id", "sale_id")
    sizes = rows.rdd.glom().map(len).collect()
    assert len(sizes) == n_lines // 200
    assert max(sizes) < 3 * n_lines // len(sizes)


@pytest.mark.parametrize("name", ["dup_rows", "dup_row_examples", "dup_business_key"])
def test_repeated_rows_of_the_flat_frame_are_found_where_they_lie(shuffled, name):
    counted = [c for c in exchanged(entry_points.queries()[name](shuffled, SF_DIR)) if "sale_id#" in c and "count#" in c]
    assert not counted


def test_dealt_rows_are_counted_like_others(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (None, "b"), (3, "c")], "a int, b string")
    for frame in (df, df.repartition(3, "a")):
        want = sorted(duplicates.duplicate_groups(frame, ["a", "b"]).collect())
        assert sorted(duplicates.duplicate_groups(frame, ["a", "b"], dealt=True).collect()) == want
        assert duplicates.duplicate_rows(frame, ["a", "b"], dealt=True).collect() == [(6, 2, 2 / 6 * 100)]
    assert len(exchanged(duplicates.duplicate_groups(df.repartition(3, "a"), ["a", "b"], dealt=True))) == 1


def test_chosen_keys_reach_the_scan_as_literals(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (2, None, 4), (3, "c", 5)], "a int, b string, v int")
    found = duplicates.duplicate_key_examples(df, ["a", "b"], ["v"])
    assert "Join" not in explained(found)
    assert [r.v for r in found.collect()] == [1, 2, 3, 4]


def test_scanned_csv_files_are_compressed(spark):
    files = entry_points.queries()["csv_scan"](spark, SF_DIR).inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)


@pytest.mark.parametrize("name", ["chk_varchar_len", "chk_not_null"])
def test_lines_are_shuffled_once_for_dates_customers_and_orders(shuffled, monkeypatch, name):
    """What is stored is few rows an order; the checks read these, and lines again for products and items only."""
    stored = []
    store = quality.materialise
    monkeypatch.setattr(quality, "materialise", lambda df, what: stored.append(store(df, what)) or stored[-1])
    found = entry_points.queries()[name](shuffled, SF_DIR)
    lines = len(re.findall(r"Scan parquet.*\n(?:.*\n)?Output \[\d+\]: \[[^\]]*l_orderkey", explained(found)))
    assert lines == {"chk_varchar_len": 1, "chk_not_null": 2}[name]
    (heads,) = stored
    n_lines = shuffled.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert 0 < heads.count() < n_lines / 2


def test_rows_chosen_among_heads_are_those_of_all_rows(spark):
    """Also with null keys and days, customers in several orders and orders of several customers."""
    rows = spark.range(400).selectExpr(
        "(id * 37) % 401 as seq",
        "if(id % 19 = 0, null, id % 60) as sale_id",
        "if(id % 17 = 0, null, (id * 7) % 11) as customer_id",
        "if(id % 13 = 0, null, date_add(date'2025-01-01', cast(id % 9 as int))) as sale_date",
        "cast(id as int) as date_id",
        "if(id % 5 = 0, null, cast(id as string)) as channel",
        "cast(id as string) as channel_campaigns",
        *[f"cast(id as string) as {c}" for c in ("first_name", "last_name", "email", "gender", "age_range", "country")],
        "date_add(date'2024-01-01', cast(id as int)) as signup_date",
    ).repartition(5)
    heads = entities.head_rows(rows, ["seq"], [*schemas.CUSTOMERS.columns, *schemas.ORDERS.columns])
    for tab in entities.HEADED:
        whole = entities.entity_rows(rows, tab, ["seq"])
        got = entities.headed_rows(heads, tab, ["seq"], tab.column_names)
        assert got.columns == whole.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())), tab.name


def test_lines_are_not_shuffled_with_the_texts_of_customers(shuffled):
    """Lines meet their products, and orders their customers, before both meet."""
    tables = {name: shuffled.createDataFrame([(None,) * len(tab.schema)], tab.schema) for name, tab in schemas.TABLES.items()}
    sent = exchanged(views.sales_lines(tables))
    assert any("item_id" in e for e in sent) and any("first_name" in e for e in sent)
    assert not any("item_id" in e and "first_name" in e for e in sent)


def test_the_calendar_is_not_shuffled_with_orders(shuffled):
    """Its columns are joined to the rows as they lie."""
    tables = {name: shuffled.createDataFrame([(None,) * len(tab.schema)], tab.schema) for name, tab in schemas.TABLES.items()}
    assert not any("day_of_week" in e for e in exchanged(views.sales_lines(tables)))


def test_nations_are_not_shuffled_with_orders(shuffled):
    assert not any("n_name" in e for e in exchanged(testtables.flat_sales(shuffled, SF_DIR)))


def test_large_results_come_in_parts_of_bounded_size(shuffled, monkeypatch):
    """``full_load``, too."""
    monkeypatch.setattr(testtables, "TASK_LINES", 200)
    rows = entry_points.queries()["full_load"](shuffled, SF_DIR).select("item_id")
    sizes = rows.rdd.glom().map(len).collect()
    assert len(sizes) == sum(sizes) // 200
    assert max(sizes) < 3 * sum(sizes) // len(sizes)


def test_a_chosen_row_holds_every_column_once(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "c"), (2, 5, None), (2, None, "d")], "k int, o int, v string")
    first = dedup.keep_first(df, "k", ["k", "o", "v"], ["k", "v", "o"])
    assert sorted(map(tuple, first.collect())) == [(1, "c", 1), (2, "d", None)]
    assert set(map(tuple, dedup.keep_last(df, "k", ["k", "o"], ["v", "k"]).collect())) == {("b", 1), (None, 2)}
    assert sorted(map(tuple, dedup.keep_last(df, "k", ["k"], ["k"]).collect())) == [(1,), (2,)]
    (struct,) = set(re.findall(r"partial_m\w+\((?:named_)?struct\(([^)]*)\)", explained(first)))
    assert re.sub(r"#\d+", "", struct) == "o, o, v, v"


def test_states_are_compared_in_their_buckets(shuffled):
    """Only the calendar, which is not in buckets, is shuffled to be compared; no item is."""
    sent = exchanged(entry_points.queries()["idempotent_reload"](shuffled, SF_DIR))
    assert not any("unit_price" in e for e in sent)
    assert sum("_new" in e for e in sent) <= 1
