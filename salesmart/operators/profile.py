"""Profile of a flat sales frame: structure, nulls, cardinality, statistics, dependencies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesmart.operators.quantiles import order_statistics, sorted_values

QUARTILES = (0.25, 0.5, 0.75)
# A sketch of this size errs by about 0.1 % of the rows; brackets allow for three times as much.
SKETCH = 4096
NEAR = 0.003


# --- per-column reports, each one global aggregate ------------------------------------------


def _one_row_per_column(df: DataFrame, columns: Sequence[str], fields) -> DataFrame:
    """One wide aggregate over ``df``, turned into a row per column.

    ``fields`` maps a column name to the aggregates of its row; they must be of one type each.
    """
    entries = []
    for position, name in enumerate(columns):
        entries.append(
            F.struct(
                F.lit(position).alias("ord"),
                F.lit(name).alias("column_name"),
                *[agg.alias(alias) for alias, agg in fields(name).items()],
            )
        )
    return df.agg(F.array(*entries).alias("_rows")).select(F.inline("_rows"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def structure(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    return _one_row_per_column(
        df,
        df.columns,
        lambda c: {"data_type": F.lit(types[c]), "n_non_null": F.count(c)},
    )


def type_mapping(df: DataFrame, recommended: Mapping[str, str]) -> DataFrame:
    types = dict(df.dtypes)
    return _one_row_per_column(
        df,
        df.columns,
        lambda c: {
            "source_type": F.lit(types[c]),
            "sql_type": F.lit(recommended[c]),
            "n_non_null": F.count(c),
        },
    )


def null_report(df: DataFrame) -> DataFrame:
    counts = _one_row_per_column(
        df, df.columns, lambda c: {"n_rows": F.count("*"), "n_null": F.count_if(F.col(c).isNull())}
    )
    return counts.withColumn("pct_null", _share(F.col("n_null"), F.col("n_rows")))


def null_alert(df: DataFrame) -> DataFrame:
    """The columns of the null report that have nulls, each with the total over all columns."""
    total = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    counts = _one_row_per_column(
        df,
        df.columns,
        lambda c: {
            "n_rows": F.count("*"),
            "n_null": F.count_if(F.col(c).isNull()),
            "n_null_total": total,
        },
    )
    return counts.filter("n_null > 0").withColumn(
        "pct_null", _share(F.col("n_null"), F.col("n_rows"))
    )


def _share(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL for an empty frame."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


# --- cardinality ----------------------------------------------------------------------------


def _as_long(df: DataFrame, name: str) -> Column | None:
    """The column as a bigint that keeps order and identity, or None if it has no such form."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.col(name).cast("bigint")
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 15:
        # Up to 15 digits a double holds the scaled value to less than half a unit, so rounding
        # gives it back exactly, without an object per value as decimal arithmetic needs.
        return F.rint(F.col(name).cast("double") * 10**dtype.scale).cast("bigint")
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (F.col(name) * 10**dtype.scale).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return F.col(name).cast("int").cast("bigint")
    return None


def _unpivot(df: DataFrame, values: Mapping[int, Column]) -> DataFrame:
    """Rows ``(ord, v)`` with the present values of the given columns."""
    cells = [F.struct(F.lit(i).alias("ord"), v.alias("v")) for i, v in values.items()]
    return df.select(F.inline(F.array(*cells))).filter("v IS NOT NULL")


def _value_columns(df: DataFrame) -> tuple[dict[int, Column], dict[int, Column]]:
    longs, texts = {}, {}
    for i, name in enumerate(df.columns):
        as_long = _as_long(df, name)
        if as_long is None:
            texts[i] = F.col(name).cast("string")
        else:
            longs[i] = as_long
    return longs, texts


def cardinality(df: DataFrame) -> DataFrame:
    """Exact distinct count of every column and its share of the rows, to one decimal.

    Numbers and dates travel as eight bytes, text as text; both are made distinct on the map
    side first, so only the distinct values of a task cross the network.
    """
    counted = [
        _unpivot(df, group).distinct().groupBy("ord").agg(F.count("*").alias("n_distinct"))
        for group in _value_columns(df)
        if group
    ]
    distinct = counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1])
    rows = _one_row_per_column(df, df.columns, lambda c: {"n_rows": F.count("*")})
    return rows.join(distinct, "ord", "left").select(
        "ord",
        "column_name",
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        "n_rows",
        F.bround(_share(F.coalesce("n_distinct", F.lit(0)), F.col("n_rows")), 1).alias("pct"),
    )


def cardinality_approx(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Distinct counts by sketch: one pass, no shuffle of values."""
    return _one_row_per_column(
        df,
        df.columns,
        lambda c: {"n_rows": F.count("*"), "n_distinct": F.approx_count_distinct(c, rsd)},
    ).withColumn("pct", F.bround(_share(F.col("n_distinct"), F.col("n_rows")), 1))


# --- descriptive statistics -----------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.IntegralType, T.DecimalType, T.FractionalType))
    ]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, as doubles.

    Exact: quartiles interpolate linearly between order statistics. A sketch in the first pass says
    about where they lie, and counts of what lies below and in these narrow brackets confirm it;
    no task holds all values. ``df`` is read several times; hand
    in stored data, not a costly derivation. NaN counts as missing.
    """
    columns = list(columns or numeric_columns(df))
    # Types without an exact bigint form, floats and wide decimals, are sorted by value.
    longs = {i: _as_long(df, c) for i, c in enumerate(columns)}
    scales = {i: getattr(df.schema[c].dataType, "scale", 0) for i, c in enumerate(columns)}

    def value(c: str) -> Column:
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        return F.when(~F.isnan(c), F.col(c)) if floating else F.col(c)

    moments = []
    for i, c in enumerate(columns):
        v = value(c)
        moments.append(
            F.struct(
                F.lit(i).alias("ord"),
                F.count(v).alias("n"),
                # The exact sum, unless it does not fit its type.
                F.coalesce(
                    F.try_divide(F.try_sum(v).cast("double"), F.count(v).cast("double")), F.avg(v.cast("double"))
                ).alias("mean"),
                F.when(F.count(v) > 1, F.stddev_samp(v.cast("double"))).alias("std"),
                (F.lit(None).cast("long") if longs[i] is None else F.min(longs[i])).alias("lo"),
                (F.lit(None).cast("long") if longs[i] is None else F.max(longs[i])).alias("hi"),
                F.min(v.cast("double")).alias("least"),
                F.max(v.cast("double")).alias("most"),
                (F.lit(None).cast("binary") if longs[i] is None else F.kll_sketch_agg_bigint(longs[i], F.lit(SKETCH))).alias("sketch"),
            )
        )
    # One row per column comes to the driver; it says where the quartiles lie, and about where.
    near = [min(1.0, max(0.0, q + side * NEAR)) for q in QUARTILES for side in (-1, 1)]
    guessed = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(q) for q in near]))
    facts = (
        df.agg(F.array(*moments).alias("r"))
        .select(F.inline("r"))
        .withColumn("guessed", F.when(F.col("sketch").isNotNull() & (F.col("n") > 0), guessed))
        .drop("sketch")
        .collect()
    )

    exact = [f for f in facts if f.n and longs[f.ord] is not None]

    def below(limits: Iterable[tuple[int, int]]) -> dict[tuple[int, int], int]:
        limits = sorted(limits)
        counts = df.agg(*[F.count_if(longs[i] < F.lit(v)).alias(f"n{at}") for at, (i, v) in enumerate(limits)]).first()
        return dict(zip(limits, counts))

    def inside(wanted: Mapping[int, set[tuple[int, int]]]) -> DataFrame:
        """The values in the brackets asked for; most rows have none in a narrow bracket."""
        held = {i: reduce(Column.__or__, [longs[i].between(lo, hi) for lo, hi in sorted(wanted[i])]) for i in sorted(wanted)}
        rows = df.filter(reduce(Column.__or__, held.values()))
        return _unpivot(rows, {i: F.when(held[i], longs[i]) for i in held})

    values = order_statistics(
        inside,
        {f.ord: (f.lo, f.hi) for f in exact},
        [(f.ord, rank) for f in exact for q in QUARTILES for rank in _around(f.n, q)],
        {
            (f.ord, rank): (f.guessed[2 * at], f.guessed[2 * at + 1])
            for f in exact
            for at, q in enumerate(QUARTILES)
            for rank in _around(f.n, q)
        },
        below,
    )
    found = {key: _unscaled(v, scales[key[0]]) for key, v in values.items()}
    for f in facts:
        if f.n and longs[f.ord] is None:
            present = df.select(value(columns[f.ord]).alias("v")).filter("v IS NOT NULL")
            ranked = sorted_values(present, [rank for q in QUARTILES for rank in _around(f.n, q)])
            found |= {(f.ord, rank): float(v) for rank, v in ranked.items()}

    def quartile(fact, q: float) -> float | None:
        if not fact.n:
            return None
        below, above = (found[fact.ord, r] for r in _around(fact.n, q))
        return below + (above - below) * ((fact.n - 1) * q % 1)

    def end(fact, exact_value: int | None, rounded: float | None) -> float | None:
        return rounded if longs[fact.ord] is None else _unscaled(exact_value, scales[fact.ord])

    return df.sparkSession.createDataFrame(
        [
            (
                f.ord, columns[f.ord], f.n, f.mean, f.std, end(f, f.lo, f.least),
                *[quartile(f, q) for q in QUARTILES], end(f, f.hi, f.most),
            )
            for f in facts
        ],
        "ord int, column_name string, n long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double",
    )


def _around(n: int, q: float) -> tuple[int, int]:
    """The 0-based ranks whose values enclose quantile ``q`` of ``n`` values."""
    below = int((n - 1) * q)
    return below, min(below + 1, n - 1)


def _unscaled(value: int | None, scale: int) -> float | None:
    return None if value is None else value / 10**scale


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, distinct count, most frequent value and its frequency of text columns.

    Among equally frequent values the smallest is shown; a column without values has none.
    """
    columns = list(
        columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    )
    frequencies = (
        _unpivot(df, {i: F.col(c) for i, c in enumerate(columns)})
        .groupBy("ord", "v")
        .agg(F.count("*").alias("freq"))
    )
    tops = frequencies.groupBy("ord").agg(
        F.sum("freq").alias("n"),
        F.count("*").alias("n_unique"),
        F.min(F.struct((-F.col("freq")).alias("neg"), F.col("v"))).alias("best"),
    )
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "ord int, column_name string")
    return names.join(tops, "ord", "left").select(
        "ord",
        "column_name",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
        F.col("best.v").alias("top"),
        (-F.col("best.neg")).alias("freq"),
    )


# --- entities, prices, orders ---------------------------------------------------------------


def distinct_entities(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_distinct("customer_id").alias("n_customers"),
        F.count_distinct("product_name").alias("n_product_names"),
    )


def dependency_violations(df: DataFrame, dependencies: Mapping[str, Sequence[str]]) -> DataFrame:
    """For every ``key -> attribute`` the number of keys that have more than one value.

    A key has several values exactly if its smallest and largest differ, so one aggregate per
    key covers all its attributes and nothing has to be made distinct.
    """
    reports = []
    for key, attributes in dependencies.items():
        bounds = [F.min(a).alias(f"lo_{a}") for a in attributes]
        bounds += [F.max(a).alias(f"hi_{a}") for a in attributes]
        per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*bounds)
        rows = [
            F.struct(
                F.lit(key).alias("key_column"),
                F.lit(a).alias("attribute"),
                F.count_if(F.col(f"lo_{a}") != F.col(f"hi_{a}")).alias("n_violating_keys"),
                F.count("*").alias("n_keys"),
            )
            for a in attributes
        ]
        reports.append(per_key.agg(F.array(*rows).alias("r")).select(F.inline("r")))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def product_price_stats(df: DataFrame) -> DataFrame:
    """Price spread per product name."""
    return (
        df.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(
            F.min("unit_price").alias("min_price"),
            F.max("unit_price").alias("max_price"),
            F.try_divide(
                F.sum("unit_price").cast("double"), F.count("unit_price").cast("double")
            ).alias("mean_price"),
            F.count("unit_price").alias("n_prices"),
            (F.max("unit_price") - F.min("unit_price")).alias("variation"),
        )
    )


def price_variation_count(df: DataFrame) -> DataFrame:
    return product_price_stats(df).agg(
        F.count_if(F.col("variation") > 0).alias("n_products_with_variation")
    )


def order_analysis(df: DataFrame) -> DataFrame:
    """Distinct customers and dates and number of lines per order."""
    return (
        df.filter(F.col("sale_id").isNotNull())
        .groupBy("sale_id")
        .agg(
            F.count_distinct("customer_id").alias("n_customers"),
            F.count_distinct("sale_date").alias("n_dates"),
            F.count("product_name").alias("n_lines"),
        )
    )


def order_conflicts(df: DataFrame) -> DataFrame:
    return order_analysis(df).agg(
        F.count_if(F.col("n_customers") > 1).alias("n_multi_customer"),
        F.count_if(F.col("n_dates") > 1).alias("n_multi_date"),
    )


def date_range(parsed: Column, df: DataFrame) -> DataFrame:
    return df.select(parsed.alias("d")).agg(
        F.count_if(F.col("d").isNull()).alias("n_invalid"),
        F.min("d").alias("first_date"),
        F.max("d").alias("last_date"),
    )


def nonpositive_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("unit_price") <= 0).alias("n_price_nonpositive"),
        F.count_if(F.col("quantity") <= 0).alias("n_quantity_nonpositive"),
    )
