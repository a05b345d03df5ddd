"""Raw files, staging, the published warehouse and the daily load."""

import csv
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesmart.operators.dedup import keep_first
from salesmart.plans.clean import CleanOptions, clean_rows, slice_days
from salesmart.plans.daily_load import LoadRejected, daily_load, load_file
from salesmart.plans.views import sales_lines
from salesmart.plans.warehouse import FACTS, Warehouse
from salesmart.schemas import RAW_NAMES, TABLES
from salesmart.sources.csv import FILE_ORDER, read_sales_csv, typed_columns
from salesmart.sources.staging import read_staged, stage_filtered, stage_raw
from salesmart.streaming.arrivals import load_arrivals

T1, T2, T3 = (datetime(2025, 6, d, 6) for d in (16, 17, 18))

LINE = dict(
    sale_date="2025-06-16", item_id="1", sale_id="1", product_id="1", quantity="2",
    original_price="10.00", unit_price="9.00", discount_applied="1.00", discount_percent="10%",
    discounted="True", item_total="0", channel="web", channel_campaigns="c", total_amount="0",
    product_name="hat", category="wear", brand="b", color="red", size="M", catalog_price="10.00",
    cost_price="5.00", customer_id="1", gender="F", age_range="20-30", signup_date="2024-01-01",
    first_name="Ann", last_name="Lee", email="ann@example.com", country="FR",
)


def write_csv(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, RAW_NAMES)
        writer.writeheader()
        writer.writerows([{**LINE, **line} for line in lines])
    return str(path)


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "mart"))
    made.bootstrap()
    return made


def load(warehouse, path, day, load_ts=T1, **kw):
    return load_file(warehouse.spark, warehouse.root, path, day, load_ts, **kw)


def state(warehouse):
    return {
        name: sorted(map(tuple, df.collect()), key=repr) for name, df in warehouse.tables().items()
    }


# --- scan and staging -----------------------------------------------------------------------------


def test_file_order_over_many_splits(spark, tmp_path):
    """The first row per key in file order, however the files are cut into tasks."""
    frames, counter = [], 0
    for f, n in enumerate((3000, 40, 900)):
        lines = []
        for i in range(n):
            lines.append({"item_id": str(counter), "customer_id": str((counter * 7) % 13), "first_name": f"n{counter}"})
            counter += 1
        write_csv(tmp_path / "raw" / f"part{f}.csv", lines)
        frames.append(pd.DataFrame(lines))
    want = pd.concat(frames).drop_duplicates("customer_id").set_index("customer_id")["first_name"].to_dict()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_sales_csv(spark, str(tmp_path / "raw"))
        assert raw.rdd.getNumPartitions() > 20
        got = keep_first(raw, "customer_id", FILE_ORDER, ["customer_id", "first_name"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.customer_id: r.first_name for r in got} == want


def test_scan(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [
        {"product_name": 'a "big", hat', "discount_percent": "NA", "customer_id": "", "quantity": "3.0"},
        {"catalog_price": "123456789012.00", "gender": "None"},
    ])
    first, second = typed_columns(read_sales_csv(spark, path)).orderBy(*FILE_ORDER).collect()
    assert first.product_name == 'a "big", hat'
    assert (first.discount_percent, first.customer_id, first.quantity) == (None, None, 3)
    assert (second.catalog_price, second.gender) == (None, None)
    assert first.signup_date == date(2024, 1, 1)


def test_scan_refuses_a_wrong_header(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        read_sales_csv(spark, str(path)).collect()


def test_staging(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{"item_id": "1"}, {"item_id": "2", "sale_date": "2025-06-17"}])
    raw = read_sales_csv(spark, path)
    by_day = stage_raw(raw, str(tmp_path / "by_day"), F.col("sale_date").cast("date"))
    day = read_staged(spark, by_day, raw.schema, [date(2025, 6, 17)])
    assert [r.item_id for r in day.collect()] == ["2"]
    assert "date_id" in day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    # Staging one day leaves the other days alone.
    target = str(tmp_path / "filtered")
    cleaned = clean_rows(slice_days(raw, [date(2025, 6, 16), date(2025, 6, 17)]))
    stage_filtered(cleaned, target)
    stage_filtered(clean_rows(slice_days(raw, [date(2025, 6, 17)])).withColumn("channel", F.lit("again")), target)
    got = read_staged(spark, target, cleaned.schema).select("date_id", "channel").collect()
    assert sorted(map(tuple, got)) == [(20250616, "web"), (20250617, "again")]


# --- load -----------------------------------------------------------------------------------------


def test_first_load(warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [
        {"item_id": "1"},
        {"item_id": "2", "channel": "late", "quantity": "1", "discounted": ""},
        {"item_id": "1", "quantity": "5"},
        {"item_id": "3", "sale_id": "2", "customer_id": "2", "email": "", "discount_percent": "bad"},
        {"item_id": "9", "sale_date": "2025-06-17"},
        {"item_id": "8", "sale_date": "junk"},
    ])
    result = load(warehouse, path, "20250616")
    assert result.status == "SUCCESS"
    assert result.metrics == {
        "read": 6, "bad_records": 0, "bad_dates": 1, "filtered": 4, "bad_percents": 1, "bad_flags": 0, "warnings": 1,
        "upserted_dim_dates": 1, "upserted_customers": 2,
        "upserted_products": 1, "upserted_orders": 2, "upserted_order_items": 3,
    }
    items = {r.item_id: r for r in warehouse.read("order_items").collect()}
    assert (items[1].quantity, items[1].item_total) == (5, Decimal("45.00"))
    assert (items[2].discounted, items[3].discount_percent) == (False, Decimal("0.00"))
    orders = {r.sale_id: r for r in warehouse.read("orders").collect()}
    assert (orders[1].channel, orders[1].date_id) == ("web", 20250616)
    assert {r.email for r in warehouse.read("customers").collect()} == {"ann@example.com", None}
    assert sales_lines(warehouse.tables()).count() == 3
    assert {r.created_at for r in warehouse.read("products").collect()} == {T1}


def test_reload_changes_nothing(warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{"item_id": "1"}, {"item_id": "2", "sale_id": "2"}])
    load(warehouse, path, "20250616", T1)
    before = state(warehouse)
    assert load(warehouse, path, "20250616", T2).status == "SUCCESS"
    assert state(warehouse) == before


def test_status_per_day(warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{}, {"item_id": "2", "sale_date": "2025-06-18"}])
    result = load(warehouse, path, ["20250616", "20250617", "20250618"])
    assert result.status == "SUCCESS"
    assert sorted(map(tuple, result.days.collect())) == [
        (20250616, "SUCCESS", 1), (20250617, "NO_DATA", 0), (20250618, "SUCCESS", 1),
    ]


def test_no_data_and_empty_source(warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{}])
    version = warehouse.manifest().version
    result = load(warehouse, path, "20250101")
    assert (result.status, result.version) == ("NO_DATA", version)
    assert [tuple(r) for r in result.days.collect()] == [(20250101, "NO_DATA", 0)]
    assert warehouse.manifest().version == version
    with pytest.raises(ValueError, match="no rows"):
        load(warehouse, write_csv(tmp_path / "empty.csv", []), "20250616")


@pytest.mark.parametrize(
    "line, rule",
    [
        ({"quantity": "0"}, "check:quantity"),
        ({"customer_id": ""}, "not_null:customer_id"),
        ({"discount_percent": "150%"}, "check:discount_percent"),
        ({"email": "ann@example.com", "customer_id": "7", "sale_id": "2"}, "unique:email"),
        ({"channel": "x" * 51, "sale_id": "2"}, "varchar:channel"),
    ],
)
def test_violation_publishes_nothing(warehouse, tmp_path, line, rule):
    load(warehouse, write_csv(tmp_path / "a.csv", [{}]), "20250616")
    before, version = state(warehouse), warehouse.manifest().version
    bad = write_csv(tmp_path / "b.csv", [{"item_id": "5"}, {"item_id": "6", **line}])
    with pytest.raises(LoadRejected) as refused:
        load(warehouse, bad, "20250616", T2)
    found = warehouse.spark.read.parquet(refused.value.path).collect()
    assert rule in {r.rule for r in found} and len(found) == refused.value.n_violations
    assert warehouse.manifest().version == version and state(warehouse) == before


def test_a_replaced_item_row_is_checked_too(warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{"quantity": "-1"}, {"quantity": "1"}])
    with pytest.raises(LoadRejected):
        load(warehouse, path, "20250616")


def test_strict_percent_fails_the_load(warehouse, tmp_path):
    path = write_csv(tmp_path / "a.csv", [{"discount_percent": "bad"}])
    version = warehouse.manifest().version
    with pytest.raises(Exception, match="not a percentage"):
        load(warehouse, path, "20250616", options=CleanOptions(percent_mode="strict"))
    assert warehouse.manifest().version == version


def test_order_moves_to_another_day(warehouse, tmp_path):
    """Both days are rewritten, a day without a touched key is not."""
    first = [{"item_id": "1"}, {"item_id": "2", "sale_id": "2", "sale_date": "2025-06-15"},
             {"item_id": "3", "sale_id": "3", "sale_date": "2025-06-14"}]
    load(warehouse, write_csv(tmp_path / "a.csv", first), ["20250614", "20250615", "20250616"])
    old = {(e.table_name, e.period): e.ver for e in warehouse.manifest().entries if e.table_name in FACTS}
    moved = [{"item_id": "1", "sale_id": "1", "sale_date": "2025-06-15", "channel": "shop"}]
    load(warehouse, write_csv(tmp_path / "b.csv", moved), "20250615", T2)
    new = {(e.table_name, e.period): e.ver for e in warehouse.manifest().entries if e.table_name in FACTS}
    orders = {r.sale_id: r for r in warehouse.read("orders").collect()}
    assert (orders[1].date_id, orders[1].channel, orders[1].created_at) == (20250615, "shop", T1)
    assert len(orders) == 3 and warehouse.read("order_items").count() == 3
    assert ("orders", 20250616) not in new
    assert new["orders", 20250614] == old["orders", 20250614]
    assert new["orders", 20250615] != old["orders", 20250615]
    assert [r.sale_id for r in warehouse.read("orders", [20250614]).collect()] == [3]


def test_last_run_wins_even_for_an_older_day(warehouse, tmp_path):
    lines = [{"first_name": "New", "sale_date": "2025-06-17", "item_id": "2", "sale_id": "2"}, {"first_name": "Old"}]
    path = write_csv(tmp_path / "a.csv", lines)
    load(warehouse, path, "20250617", T1)
    load(warehouse, path, "20250616", T2)
    customer = warehouse.read("customers").first()
    assert (customer.first_name, customer.created_at, customer.updated_at) == ("Old", T1, T1)


@pytest.mark.parametrize("by", ["day", "month", "year"])
def test_backfill_equals_day_by_day(spark, tmp_path, by):
    lines = [
        {"item_id": str(i), "sale_id": str(i // 2), "sale_date": f"2025-0{1 + i % 3}-1{i % 5}",
         "customer_id": str(i % 4), "email": f"{i % 4}@example.com", "first_name": f"n{i}"}
        for i in range(12)
    ]
    path = write_csv(tmp_path / "a.csv", lines)
    days = sorted({line["sale_date"].replace("-", "") for line in lines})
    together = Warehouse(spark, str(tmp_path / "one"))
    together.bootstrap(by)
    load(together, path, days)
    assert together.read("order_items").count() == 12
    assert together.read("orders").count() == 6
    assert together.read("dim_dates").count() == len(days)
    assert together.read("order_items", [int(days[0])]).count() <= 12


def test_bootstrap(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "mart"))
    with pytest.raises(ValueError):
        made.bootstrap("week")
    made.bootstrap()
    for name, table in TABLES.items():
        frame = made.read(name)
        assert frame.schema.fieldNames() == table.schema.fieldNames() and frame.count() == 0
    load(made, write_csv(tmp_path / "a.csv", [{}]), "20250616")
    made.bootstrap()
    assert made.read("orders").count() == 0


def test_parquet_source_by_day(spark, warehouse, tmp_path):
    raw = read_sales_csv(spark, write_csv(tmp_path / "a.csv", [{}, {"item_id": "2", "sale_date": "2025-06-17"}]))
    staged = stage_raw(raw, str(tmp_path / "raw"), F.col("sale_date").cast("date"))
    source = read_staged(spark, staged, raw.schema, [date(2025, 6, 17)])
    result = daily_load(
        warehouse, source, [date(2025, 6, 17)], T1, FILE_ORDER, count_source=False
    )
    assert result.status == "SUCCESS" and "read" not in result.metrics
    assert [r.item_id for r in warehouse.read("order_items").collect()] == [2]


# --- stream ---------------------------------------------------------------------------------------


def test_arriving_files(spark, warehouse, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    write_csv(folder / "0616.csv", [{"item_id": "1"}])
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T1).awaitTermination()
    write_csv(folder / "0617.csv", [{"item_id": "2", "sale_id": "2", "sale_date": "2025-06-17", "first_name": "Eve"}])
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T2).awaitTermination()
    version = warehouse.manifest().version
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T3).awaitTermination()
    assert warehouse.manifest().version == version
    assert sorted(r.item_id for r in warehouse.read("order_items").collect()) == [1, 2]
    assert warehouse.read("customers").first().first_name == "Eve"


def test_refused_files_do_not_block_the_others(spark, warehouse, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    write_csv(folder / "a.csv", [{"quantity": "0"}])
    good = write_csv(folder / "b.csv", [{"item_id": "2"}])
    text = open(good).read()
    (folder / "c.csv").write_text(text.replace("first_name,last_name", "last_name,first_name", 1))
    (folder / "d.csv").write_text(text.rstrip("\n") + ",surplus\n")
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T1).awaitTermination()
    assert [r.item_id for r in warehouse.read("order_items").collect()] == [2]
    refused = spark.read.parquet(f"{warehouse.root}/refused").collect()
    assert sorted(r.path[-5:] for r in refused) == ["a.csv", "c.csv", "d.csv"]


def taken(warehouse):
    return {r.source[-5:]: r for r in warehouse.loads().collect()}


def test_an_undated_file_is_refused_with_its_counts(spark, warehouse, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    write_csv(folder / "a.csv", [{"sale_date": "never"}, {"sale_date": ""}])
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T1).awaitTermination()
    write_csv(folder / "b.csv", [{"item_id": "2"}])
    write_csv(folder / "e.csv", [])
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T2).awaitTermination()
    assert [r.item_id for r in warehouse.read("order_items").collect()] == [2]
    found = taken(warehouse)
    assert {k: r.status for k, r in found.items()} == {"a.csv": "REFUSED", "b.csv": "SUCCESS", "e.csv": "REFUSED"}
    assert found["a.csv"].metrics == {"read": 2, "bad_records": 0, "bad_dates": 2}
    assert found["a.csv"].reason == "no row has a valid date" and found["a.csv"].loaded_at == T1
    assert {r.path[-5:] for r in spark.read.parquet(f"{warehouse.root}/refused").collect()} == {"a.csv", "e.csv"}


def test_undated_rows_and_replaced_values_of_a_file_are_counted(spark, warehouse, tmp_path):
    folder = tmp_path / "in"
    write_csv(folder / "a.csv", [
        {"item_id": "1"}, {"item_id": "2", "sale_date": "never"},
        {"item_id": "3", "discount_percent": "many"}, {"item_id": "4", "discounted": "perhaps"},
    ])
    load_arrivals(spark, str(folder), warehouse.root, str(tmp_path / "cp"), T1).awaitTermination()
    record = taken(warehouse)["a.csv"]
    want = {"read": 4, "filtered": 3, "bad_dates": 1, "bad_records": 0, "bad_percents": 1, "bad_flags": 1, "upserted_order_items": 3}
    assert record.status == "SUCCESS" and want.items() <= record.metrics.items()
    assert record.version == warehouse.manifest().version


def test_a_repeated_epoch_changes_nothing(spark, warehouse, tmp_path):
    from salesmart.streaming.arrivals import load_epoch

    paths = [
        write_csv(tmp_path / "in" / "a.csv", [{"item_id": "1", "first_name": "Ann"}]),
        write_csv(tmp_path / "in" / "b.csv", [{"sale_date": "never"}]),
        write_csv(tmp_path / "in" / "c.csv", [{"item_id": "3", "first_name": "Eve"}]),
    ]
    files = [(p, datetime(2025, 6, 1 + i)) for i, p in enumerate(paths)]

    def epoch(n, some, ts):
        load_epoch(spark, warehouse.root, spark.createDataFrame(some, "path string, modificationTime timestamp"), n, "s", ts)

    epoch(0, files[:2], T1)  # lost before the stream noted the epoch, with one file to go
    before, version = state(warehouse), warehouse.manifest().version
    epoch(0, files[:2], T2)
    assert (state(warehouse), warehouse.manifest().version) == (before, version)
    epoch(0, files, T2)
    assert sorted(r.item_id for r in warehouse.read("order_items").collect()) == [1, 3]
    assert warehouse.loads().count() == 3 and spark.read.parquet(f"{warehouse.root}/refused").count() == 1
    version = warehouse.manifest().version
    epoch(1, files[:1], T3)  # another epoch is another load
    assert warehouse.manifest().version == version + 1


def test_what_is_not_the_files_fault_fails_the_run(spark, warehouse, tmp_path, monkeypatch):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    write_csv(folder / "a.csv", [{"item_id": "1"}])
    publish = Warehouse.publish

    def beaten(self, manifest, load=None):
        publish(self, manifest, load)
        publish(self, manifest, load)

    monkeypatch.setattr(Warehouse, "publish", beaten)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        load_arrivals(spark, str(folder), warehouse.root, checkpoint, T1).awaitTermination()
    monkeypatch.undo()
    assert not warehouse.loads().filter("status = 'REFUSED'").count()
    # The lost race had published this very file, so the repeated epoch has nothing left to do.
    load_arrivals(spark, str(folder), warehouse.root, checkpoint, T2).awaitTermination()
    assert [(r.item_id, r.created_at) for r in warehouse.read("order_items").collect()] == [(1, T1)]


def test_history_is_counted_from_sketches(spark, tmp_path):
    mart = Warehouse(spark, str(tmp_path / "mart"))
    mart.bootstrap("month", buckets=2)
    assert mart.cardinality("orders").count() == 0
    lines = [{"item_id": str(i), "sale_id": str(i), "sale_date": f"2025-0{1 + i % 3}-10", "quantity": str(1 + i % 7)} for i in range(600)]
    days = ["20250110", "20250210", "20250310"]
    load(mart, write_csv(tmp_path / "a.csv", lines), days, T1)
    again = [{**line, "quantity": "9"} for line in lines[::3]]  # January, all of it
    load(mart, write_csv(tmp_path / "b.csv", again), days, T2)

    def counts(*date_ids):
        return {r.column_name: (r.n_rows, r.n_non_null, r.n_distinct) for r in mart.cardinality("order_items", date_ids or None).collect()}

    every = counts()
    assert every["quantity"] == (600, 600, 8) and every["product_id"] == (600, 600, 1)
    assert every["item_id"][0] == 600 and abs(every["item_id"][2] - 600) <= 30
    assert counts(20250110)["quantity"] == (200, 200, 1) and counts(20250210)["quantity"][2] == 7
    assert all("/sketches/order_items/" in path for path in mart.cardinality("order_items").inputFiles())


def test_totals_are_kept_up_to_date(spark, tmp_path, monkeypatch):
    """Corrected, moved and new items over several loads, with runs summed in between."""
    from salesmart.plans import warehouse as stored
    from salesmart.plans.views import orders_with_stored_total, orders_with_total

    monkeypatch.setattr(stored, "RUNS", 3)
    mart = Warehouse(spark, str(tmp_path / "mart"))
    mart.bootstrap("year", buckets=2)
    assert mart.order_totals().count() == 0
    first = [{"item_id": str(i), "sale_id": str(i // 2)} for i in range(12)]
    changes = [
        first,
        [{**first[0], "quantity": "5"}, {"item_id": "20", "sale_id": "3"}],
        [{**first[1], "sale_id": "9"}, {**first[2], "sale_id": "9"}, {**first[3], "sale_id": "9"}, {"item_id": "1", "sale_id": "0"}],
        [{"item_id": "30", "sale_id": "30", "unit_price": "0.00", "discount_applied": "10.00"}],
    ]
    for n, lines in enumerate(changes):
        load(mart, write_csv(tmp_path / f"{n}.csv", lines), "20250616", T1)
        want = orders_with_total(mart.read("orders"), mart.read("order_items"))
        got = orders_with_stored_total(mart.read("orders"), mart.order_totals())
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
        counts = {r.sale_id: r["count"] for r in mart.read("order_items").groupBy("sale_id").count().collect()}
        assert {r.sale_id: r.n_items for r in mart.order_totals().collect()} == counts
    assert len(mart.manifest().of("order_totals")) == 2
    assert "Exchange" not in mart.order_totals()._jdf.queryExecution().executedPlan().toString()


def test_addresses_are_counted_as_they_change(spark, tmp_path):
    mart = Warehouse(spark, str(tmp_path / "mart"))
    mart.bootstrap("year", buckets=2)

    def customers(n, *pairs):
        lines = [{"item_id": str(100 * n + i), "sale_id": str(100 * n + i), "customer_id": c, "email": e} for i, (c, e) in enumerate(pairs)]
        return load(mart, write_csv(tmp_path / f"{n}.csv", lines), "20250616", T1)

    customers(1, ("1", "a"), ("2", "b"), ("3", ""), ("4", ""))
    customers(2, ("1", "b"), ("2", "a"))  # swapped
    for pairs in ([("5", "a")], [("3", "b")], [("6", "c"), ("7", "c")]):
        with pytest.raises(LoadRejected) as error:
            customers(3, *pairs)
        found = spark.read.parquet(error.value.path).collect()
        assert [(r.rule, r.pk, r.value) for r in found] == [("unique:email", pairs[0][1], "2")]
    customers(4, ("1", "d"), ("2", ""), ("8", "a"), ("9", "b"))  # addresses that were given up are free
    from salesmart.plans.warehouse import EMAILS

    manifest = mart.manifest()
    counts = mart.sums(EMAILS, manifest.of(EMAILS.name), manifest.buckets)
    assert {r.email: r.n_customers for r in counts.collect()} == {"a": 1, "b": 1, "d": 1}
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_a_load_needs_a_day(warehouse, tmp_path):
    raw = read_sales_csv(warehouse.spark, write_csv(tmp_path / "a.csv", [{}]))
    with pytest.raises(ValueError, match="no day"):
        daily_load(warehouse, raw, [], T1, FILE_ORDER)


def test_a_merge_by_key_does_not_shuffle(spark, tmp_path):
    """Nothing of the target is shuffled, nor the staged batch, and a bucket stays in two files."""
    import glob

    from salesmart.operators.merge import upsert
    from salesmart.plans.daily_load import _side_by_side

    mart = Warehouse(spark, str(tmp_path / "mart"))
    mart.bootstrap("year", buckets=4)
    lines = [{"item_id": str(i), "sale_id": str(i // 3), "quantity": "1"} for i in range(60)]
    path = write_csv(tmp_path / "a.csv", lines)
    for ts in (T1, T2, T3):
        load(mart, path, "20250616", ts)
    manifest = mart.manifest()
    table = TABLES["order_items"]
    target = mart.merge_side("order_items", manifest.of("order_items"), manifest.buckets)
    plan = upsert(target, _side_by_side("order_items", target), table, T3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    declared = {t.name for t in spark.catalog.listTables()}
    mart.forget()
    assert len(declared) - len(spark.catalog.listTables()) == 1  # nothing is left of the loads
    ver = manifest.of("order_items")[0].ver
    assert len(glob.glob(f"{mart.root}/order_items/ver={ver}/period=2025/*.parquet")) <= 2 * 4


def test_malformed_records_are_refused_and_listed(spark, warehouse, tmp_path):
    path = write_csv(tmp_path / "bad.csv", [{"item_id": str(i)} for i in range(1, 4)])
    lines = open(path).read().splitlines()
    lines[2] += ",surplus"
    lines[3] = ",".join(lines[3].split(",")[:12])
    open(path, "w").write("\n".join(lines) + "\n")
    with pytest.raises(LoadRejected, match="2 malformed records") as error:
        load(warehouse, path, "20250616")
    assert spark.read.parquet(error.value.path).count() == 2
    assert warehouse.read("order_items").count() == 0


def test_line_breaks_inside_quotes(spark, warehouse, tmp_path):
    path = write_csv(tmp_path / "lines.csv", [{"product_name": "two\nlines"}])
    with pytest.raises(LoadRejected, match="malformed"):
        load(warehouse, path, "20250616")
    assert load(warehouse, path, "20250616", multiline=True).status == "SUCCESS"
    assert warehouse.read("products").first().product_name == "two\nlines"


def test_rows_without_a_date_are_counted(warehouse, tmp_path):
    path = write_csv(tmp_path / "dates.csv", [{}, {"item_id": "2", "sale_date": "2025/06/16"}, {"item_id": "3", "sale_date": ""}])
    metrics = load(warehouse, path, "20250616").metrics
    assert (metrics["read"], metrics["filtered"], metrics["bad_dates"]) == (3, 1, 2)


def test_a_second_writer_is_refused(spark, warehouse):
    from pyspark.errors import AnalysisException

    following = warehouse.manifest().next(warehouse.manifest().entries)
    warehouse.publish(following)
    with pytest.raises(AnalysisException):
        warehouse.publish(following)
    log = spark.read.parquet(f"{warehouse.root}/manifest/version={following.version}")
    log.write.mode("append").parquet(f"{warehouse.root}/manifest/version={following.version}")
    with pytest.raises(ValueError, match="published twice"):
        warehouse.manifest()


def test_scratch_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from salesmart.session import scratch_path

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="spark://host:7077")
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "x")


# --- command line ---------------------------------------------------------------------------------


def test_command_line(spark, tmp_path, capsys):
    from salesmart.__main__ import main

    root, path = str(tmp_path / "mart"), write_csv(tmp_path / "a.csv", [{}])
    assert main(["init", root]) == 0
    assert main(["load", root, path, "2025-06-16"]) == 1
    assert main(["load", root, path, "20250616"]) == 0
    assert "SUCCESS" in capsys.readouterr().out
    assert main(["load", root, path, "20250101"]) == 0
    assert "NO_DATA" in capsys.readouterr().out
    assert main(["load", root, write_csv(tmp_path / "b.csv", [{"quantity": "0"}]), "20250616"]) == 1
    assert "constraint violations" in capsys.readouterr().err
