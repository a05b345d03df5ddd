"""Deduplication, merge, delete, quality and profile operators on small tables."""

import random
from datetime import datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesmart.operators import duplicates, profile, quantiles
from salesmart.operators.dedup import keep_first, keep_last
from salesmart.operators.merge import delete_orders, delete_restricted, upsert, with_stamps
from salesmart.operators.quality import (
    check_rules, coercion_rules, duplicate_violations, error_rules, key_violations, orphan_keys,
    reference_violations, row_violations, warning_rules,
)
from salesmart.plans.views import orders_with_total
from salesmart.schemas import CUSTOMERS, DIM_DATES, ORDER_ITEMS, PRODUCTS, Table
from pyspark.sql import types as T

T1, T2 = datetime(2025, 6, 16, 6), datetime(2025, 6, 17, 6)
TINY = Table("tiny", "", "k", {"k": T.LongType(), "v": T.StringType()}, ("v",), ("created_at",))


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_first_and_last(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (None, 4, "d")], "k int, seq int, v string"
    )
    assert rows(keep_first(df, "k", ["seq"], ["k", "v"]), "v") == [(1, "a"), (None, "c")]
    assert rows(keep_last(df, "k", ["seq"], ["k", "v"]), "v") == [(1, "b"), (None, "d")]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_choice_does_not_depend_on_partitions(spark, parts):
    """A third of all rows share one key; pandas in file order is the truth."""
    rng = random.Random(5)
    data = [(0 if i % 3 == 0 else rng.randrange(50), i, str(rng.random())) for i in range(3000)]
    frame = pd.DataFrame(data, columns=["k", "seq", "v"])
    df = spark.createDataFrame(data, "k int, seq int, v string").repartition(parts, "v")
    for choose, keep in ((keep_first, "first"), (keep_last, "last")):
        want = frame.drop_duplicates("k", keep=keep).sort_values("k")[["k", "v"]]
        assert rows(choose(df, "k", ["seq"], ["k", "v"]), "k") == list(want.itertuples(index=False, name=None))


def test_upsert(spark):
    target = with_stamps(spark.createDataFrame([(1, "x"), (3, "y")], "k long, v string"), TINY, T1)
    batch = spark.createDataFrame([(1, None), (2, "z")], "k long, v string")
    updated = upsert(target, batch, TINY, T2)
    assert rows(updated, "k") == [(1, None, T1), (2, "z", T2), (3, "y", T1)]
    ignored = upsert(target, batch, TINY, T2, update_columns=())
    assert rows(ignored, "k") == [(1, "x", T1), (2, "z", T2), (3, "y", T1)]


def test_update_time_is_kept_unless_asked(spark):
    cols = "product_id int, product_name string, category string, brand string, color string, size string, catalog_price decimal(12,2), cost_price decimal(12,2)"
    old = spark.createDataFrame([(1, "a", "c", "b", "r", "s", Decimal(2), Decimal(1))], cols)
    new = spark.createDataFrame([(1, "n", "c", "b", "r", "s", Decimal(3), Decimal(1))], cols)
    target = with_stamps(old, PRODUCTS, T1)
    row = upsert(target, new, PRODUCTS, T2).first()
    assert (row.product_name, row.created_at, row.updated_at) == ("n", T1, T1)
    row = upsert(target, new, PRODUCTS, T2, touch_updated_at=True).first()
    assert (row.product_name, row.created_at, row.updated_at) == ("n", T1, T2)
    row = upsert(target, new, PRODUCTS, T2, update_columns=["catalog_price"]).first()
    assert (row.product_name, row.catalog_price) == ("a", Decimal(3))


def test_deletes(spark):
    orders = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "sale_id long, customer_id long")
    items = spark.createDataFrame([(5, 1), (6, 2), (7, 2)], "item_id long, sale_id long")
    left_orders, left_items = delete_orders(orders, items, spark.createDataFrame([(2,), (9,)], "sale_id long"))
    assert rows(left_orders.select("sale_id"), "sale_id") == [(1,), (3,)]
    assert rows(left_items.select("item_id"), "item_id") == [(5,)]
    doomed = spark.createDataFrame([(10,), (12,)], "customer_id long")
    assert rows(delete_restricted(doomed, "customer_id", orders), "customer_id") == [(10, 2)]


def test_order_totals(spark):
    orders = spark.createDataFrame([(1,), (2,)], "sale_id long")
    items = spark.createDataFrame([(1, Decimal("7.00")), (1, None)], "sale_id long, item_total decimal(12,2)")
    assert rows(orders_with_total(orders, items), "sale_id") == [(1, Decimal("7.00")), (2, Decimal("0.00"))]


# --- quality ------------------------------------------------------------------------------------


def rules_hit(df, table, rules):
    return sorted((r.pk, r.rule) for r in row_violations(df, table, rules).collect())


def customers(spark, data):
    names = "customer_id long, first_name string, last_name string, email string, gender string, age_range string, signup_date date, country string"
    return spark.createDataFrame(data, names)


def test_gender_rules(spark):
    df = customers(spark, [(1, "a", "b", "e", "X", "r", None, "c"), (2, "a", "b", "f", None, "r", None, "c")])
    assert rules_hit(df, CUSTOMERS, check_rules(df, CUSTOMERS)) == []
    assert rules_hit(df, CUSTOMERS, warning_rules(df, CUSTOMERS)) == [("1", "warn:gender")]


def items(spark, data):
    names = "item_id long, sale_id long, product_id int, quantity string, original_price string, unit_price string, discount_applied string, discount_percent double, discounted boolean"
    return spark.createDataFrame(data, names)


@pytest.mark.parametrize(
    "applied, percent, broken",
    [("0", 0.0, False), ("1", 0.0, False), ("0", 5.0, False), (None, 0.0, False), ("-1", 0.0, True)],
)
def test_discount_consistency(spark, applied, percent, broken):
    df = items(spark, [(1, 1, 1, "1", "2", "2", applied, percent, False)])
    hit = rules_hit(df, ORDER_ITEMS, check_rules(df, ORDER_ITEMS))
    assert (("1", "check:discount_consistency") in hit) is broken
    assert (("1", "check:discount_applied") in hit) is broken


def test_item_rules(spark):
    df = items(
        spark,
        [
            (1, 1, 1, "1", "2", "2", "0", 0.0, False),
            (2, 1, 1, "0", "-2", "-2", "0", 150.0, False),
            (3, None, 1, "x", "2", "99999999999", "0", 0.0, True),
        ],
    )
    assert rules_hit(df, ORDER_ITEMS, error_rules(df, ORDER_ITEMS)) == [
        ("2", "check:discount_percent"),
        ("2", "check:original_price"),
        ("2", "check:quantity"),
        ("2", "check:unit_price"),
        ("3", "coercion:quantity"),
        ("3", "coercion:unit_price"),
        ("3", "not_null:sale_id"),
    ]
    assert rules_hit(df, ORDER_ITEMS, warning_rules(df, ORDER_ITEMS)) == [
        ("2", "warn:discount_flag"), ("3", "warn:discount_flag"),
    ]


def test_item_total_overflow(spark):
    df = items(spark, [(1, 1, 1, "2000000000", "1", "9999999999", "0", 0.0, False)])
    assert rules_hit(df, ORDER_ITEMS, error_rules(df, ORDER_ITEMS)) == [("1", "coercion:item_total")]


def test_lengths_and_overflow(spark):
    names = "product_id int, product_name string, category string, brand string, color string, size string, catalog_price decimal(18,2), cost_price decimal(18,2)"
    df = spark.createDataFrame(
        [(1, "n", "c", "b", "x" * 51, "s", Decimal("99999999999.99"), Decimal(5)),
         (2, None, "c", "b", "r", "s", Decimal(4), Decimal(5))], names)
    assert rules_hit(df, PRODUCTS, error_rules(df, PRODUCTS)) == [
        ("1", "coercion:catalog_price"), ("1", "varchar:color"),
        ("2", "check:cost_price"), ("2", "not_null:product_name"),
    ]
    assert rules_hit(df, PRODUCTS, coercion_rules(df, PRODUCTS)) == [("1", "coercion:catalog_price")]


def test_unique_and_keys(spark):
    dates = spark.createDataFrame([(1, "2025-06-16"), (2, "2025-06-16"), (3, None), (4, None)], "date_id int, d string")
    dates = dates.select("date_id", F.col("d").cast("date").alias("full_date"))
    found = duplicate_violations(dates, DIM_DATES, "full_date", "unique:full_date", dates)
    assert [(r.pk, r.value) for r in found.collect()] == [("2025-06-16", "2")]
    keys = spark.createDataFrame([(1,), (1,), (None,), (None,)], "date_id int")
    found = [(r.rule, r.pk or "", r.value or "") for r in key_violations(keys, DIM_DATES).collect()]
    assert sorted(found) == [
        ("not_null:date_id", "", ""), ("not_null:date_id", "", ""), ("unique:date_id", "1", "2"),
    ]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "customer_id long")
    parent = spark.createDataFrame([(2,), (9,)], "customer_id long")
    assert rows(orphan_keys(child, "customer_id", parent, "customer_id"), "customer_id") == [(1, 2), (3, 1)]
    likely = spark.createDataFrame([(3,)], "customer_id long")
    found = orphan_keys(child, "customer_id", parent, "customer_id", likely)
    assert rows(found, "customer_id") == [(1, 2)]


def test_references(spark):
    orders = spark.createDataFrame([(1, 20250616, 7)], "sale_id long, date_id int, customer_id long")
    items = spark.createDataFrame([(5, 1, 3), (6, 2, 4)], "item_id long, sale_id long, product_id int")
    parents = {
        "dim_dates": spark.createDataFrame([(20250616,)], "date_id int"),
        "customers": spark.createDataFrame([(8,)], "customer_id long"),
        "products": spark.createDataFrame([(3,)], "product_id int"),
        "orders": orders,
    }
    children = {"orders": orders, "order_items": items}
    found = reference_violations(children, parents)
    want = [("orders", "references:customer_id", "7"), ("order_items", "references:product_id", "4"),
            ("order_items", "references:sale_id", "2")]
    assert sorted((r.table_name, r.rule, r.pk) for r in found.collect()) == sorted(want)
    late = {"products": spark.createDataFrame([(4,)], "product_id int")}
    assert reference_violations(children, parents, likely=late).count() == 2


# --- profile ------------------------------------------------------------------------------------


def test_describe_small(spark):
    df = spark.createDataFrame([(1, Decimal("1.00")), (2, None), (3, None), (4, None)], "a int, b decimal(12,2)")
    a, b = sorted(profile.describe_numeric(df).collect(), key=lambda r: r.ord)
    assert (a.n, a["mean"], a.p25, a.p50, a.p75, a.min, a.max) == (4, 2.5, 1.75, 2.5, 3.25, 1.0, 4.0)
    assert a.std == pytest.approx(1.2909944)
    assert (b.n, b["mean"], b.std, b.p50) == (1, 1.0, None, 1.0)


def test_describe_empty(spark):
    df = spark.createDataFrame([], "a int")
    row = profile.describe_numeric(df).first()
    assert (row.n, row["mean"], row.p50, row.max) == (0, None, None, None)


def test_describe_like_pandas(spark):
    """Wide, skewed and narrow columns; several passes are needed for the wide ones."""
    rng = np.random.default_rng(3)
    n = 4000
    frame = pd.DataFrame(
        {
            "wide": rng.integers(-(10**15), 10**15, n),
            "skewed": np.where(rng.random(n) < 0.4, 7, (10 ** (rng.random(n) * 12)).astype("int64")),
            "narrow": rng.integers(0, 5, n),
            "big_gap": np.where(rng.random(n) < 0.5, 0, 10**14),
        }
    )
    df = spark.createDataFrame(frame).repartition(7)
    got = {r.column_name: r for r in profile.describe_numeric(df).collect()}
    want = frame.describe()
    for c in frame.columns:
        for mine, theirs in (("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("min", "min"), ("max", "max")):
            assert got[c][mine] == pytest.approx(want[c][theirs], rel=1e-12), (c, mine)
        assert got[c]["std"] == pytest.approx(want[c]["std"], rel=1e-9)


def test_order_statistics_every_rank(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FANOUT", 4)
    values = [5, 5, 5, -3, 100, 17, 17, 2, 0, 63, 64, 65]
    long_values = spark.createDataFrame([(0, v) for v in values], "ord int, v long")
    ranks = [(0, i) for i in range(len(values))]
    found = quantiles.order_statistics(
        lambda wanted: long_values, {0: (min(values), max(values))}, ranks
    )
    assert [found[0, i] for i in range(len(values))] == sorted(values)


def test_describe_whole_bigint_range(spark):
    values = [-(2**63), -5, 0, 7, 2**63 - 1]
    row = profile.describe_numeric(spark.createDataFrame([(v,) for v in values], "a long")).first()
    assert (row.p25, row.p50, row.p75) == (-5.0, 0.0, 7.0)


def test_describe_floats_and_wide_decimals(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1e6, 500), np.full(300, 2.5), [np.nan, np.inf, 1e-300]])
    frame = spark.createDataFrame(
        [(float(v), float(np.float32(v)), None if i % 3 else Decimal(10) ** 24 * i) for i, v in enumerate(x)],
        "x double, f float, d decimal(38,2)",
    ).repartition(5)
    got = {r.column_name: r for r in profile.describe_numeric(frame).collect()}
    want = pd.Series(x).dropna()
    assert got["x"].n == got["f"].n == len(want)
    for mine, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert got["x"][mine] == pytest.approx(want.quantile(q), rel=1e-12)
    assert got["d"].n == len(range(0, len(x), 3)) and got["d"].p50 == pytest.approx(1e24 * np.median(range(0, len(x), 3)))
    empty = profile.describe_numeric(frame.limit(0)).collect()
    assert [(r.column_name, r.n, r.p50) for r in sorted(empty)] == [("x", 0, None), ("f", 0, None), ("d", 0, None)]


def test_text_and_cardinality(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("b", 1, None), ("b", 2, None), ("a", None, None)], "t string, n int, e string"
    )
    text = {r.column_name: r for r in profile.describe_text(df).collect()}
    assert (text["t"].n, text["t"].n_unique, text["t"].top, text["t"].freq) == (4, 2, "a", 2)
    assert (text["e"].n, text["e"].n_unique, text["e"].top, text["e"].freq) == (0, 0, None, None)
    counts = {r.column_name: (r.n_distinct, r.n_rows, r.pct) for r in profile.cardinality(df).collect()}
    assert counts == {"t": (2, 4, 50.0), "n": (2, 4, 50.0), "e": (0, 4, 0.0)}
    nulls = {r.column_name: (r.n_null, r.pct_null) for r in profile.null_report(df).collect()}
    assert nulls == {"t": (0, 0.0), "n": (1, 25.0), "e": (4, 100.0)}
    assert {r.column_name for r in profile.null_alert(df).collect()} == {"n", "e"}
    assert {r.n_null_total for r in profile.null_alert(df).collect()} == {5}


def test_dependencies(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", None), (2, "a", "x"), (2, "b", "y"), (None, "p", "q"), (None, "r", "s")],
        "k int, v string, w string",
    )
    found = {r.attribute: (r.n_violating_keys, r.n_keys) for r in profile.dependency_violations(df, {"k": ["v", "w"]}).collect()}
    assert found == {"v": (1, 2), "w": (1, 2)}


def test_duplicates_against_pandas(spark):
    """A third of all rows are copies of one row; NULL equals NULL."""
    rng = random.Random(11)
    data = [
        (1, "hot") if i % 3 == 0 else (rng.choice([None, *range(40)]), rng.choice([None, "a", "b"]))
        for i in range(600)
    ]
    frame = pd.DataFrame(data, columns=["a", "b"])
    df = spark.createDataFrame(data, "a int, b string").repartition(5)
    n = int(frame.duplicated().sum())
    for report in (duplicates.duplicate_rows(df, ["a", "b"]), duplicates.duplicate_keys(df, ["a", "b"])):
        assert tuple(report.first()) == (600, n, pytest.approx(n / 600 * 100))
    members = frame[frame.duplicated(keep=False)].sort_values(["a", "b"]).head(10)
    want = [(None if pd.isna(a) else int(a), None if pd.isna(b) else b) for a, b in members.itertuples(index=False)]
    assert [tuple(r) for r in duplicates.duplicate_row_examples(df, ["a", "b"]).collect()] == want
    assert [tuple(r) for r in duplicates.duplicate_key_examples(df, ["a", "b"], []).collect()] == want


def test_unique_rows_are_not_shuffled_whole(spark):
    df = spark.range(1000).select((F.col("id") % 990).alias("a"), F.repeat(F.lit("x"), 100).alias("b"))
    groups = duplicates.duplicate_groups(df, ["a", "b"])
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("hashpartitioning") == 1
    assert groups.count() == 10


def test_quartiles_that_a_sketch_misses(spark):
    """Wrong brackets are noticed by their counts."""
    values = spark.createDataFrame([(0, v) for v in range(100)], "ord int, v long")
    guesses = {(0, 10): (20, 30), (0, 50): (40, 60), (0, 90): (70, 80), (0, 0): (0, 0)}
    found = quantiles.order_statistics(
        lambda wanted: values, {0: (0, 99)}, list(guesses), guesses, lambda limits: {(i, v): v for i, v in limits}
    )
    assert found == {(0, r): r for r in (0, 10, 50, 90)}


def test_no_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "a int, b string")
    assert tuple(duplicates.duplicate_rows(df, ["a", "b"]).first()) == (2, 0, 0.0)
    assert duplicates.duplicate_row_examples(df, ["a", "b"]).count() == 0
    empty = df.limit(0)
    assert tuple(duplicates.duplicate_rows(empty, ["a", "b"]).first()) == (0, 0, None)
    assert tuple(duplicates.duplicate_keys(empty, ["a"]).first()) == (0, 0, None)
