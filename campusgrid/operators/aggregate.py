"""One-pass group profiles and whole-table summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, flag_equals, number, present, to_integer
from .columns import columns_by_type
from .quantiles import exact_quantiles


def profile(df: DataFrame, key: str | Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per non-null key with all the given aggregates: one shuffle, partial
    aggregation on the map side."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(present(df, keys)).groupBy(*[as_column(k) for k in keys]).agg(*aggregates)


def row_count() -> Column:
    return F.count(F.lit(1))


def number_max(c: str | Column) -> Column:
    """Maximum of a column that may hold numbers as text ('10' is above '2')."""
    return F.max(to_integer(c).try_cast("int"))


def flag_sum(c: str | Column, value: str = "1") -> Column:
    """How many rows equal ``value``."""
    return F.sum(flag_equals(c, value).cast("bigint"))


def value_count(c: str | Column, value: str) -> Column:
    """Rows of the group equal to ``value``; null when the group never has a value at all."""
    column = as_column(c)
    return F.when(F.count(column) > 0, F.count_if(column == F.lit(value)))


def first_value(c: str | Column, order: str | Column) -> Column:
    """First non-null value by an explicit order."""
    column = as_column(c)
    return F.min_by(column, F.when(column.isNotNull(), as_column(order)))


def mean_of_difference(df: DataFrame, a: str, b: str, name: str = "mean_difference") -> DataFrame:
    return df.agg(F.avg(as_column(a) - as_column(b)).alias(name))


def group_means(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Size and mean of every column per group; nulls and NaN are skipped."""
    return profile(df, key, row_count().alias("size"), *[F.avg(number(c)).alias(c) for c in cols])


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column; nulls and NaN are skipped.

    Quartiles are exact and interpolated, found by narrowing histograms instead of
    holding all values of a column in one task."""
    cols = list(cols or columns_by_type(df)[0])
    numbers = df.select(*[number(c).alias(f"x{i}") for i, c in enumerate(cols)])
    aggregates = []
    for i in range(len(cols)):
        x = F.col(f"x{i}")
        aggregates.append(F.struct(F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)).alias(f"x{i}"))
    basics = numbers.agg(*aggregates).first()
    points = exact_quantiles(numbers, numbers.columns, [0.25, 0.5, 0.75])
    rows = []
    for i, c in enumerate(cols):
        n, mean, std, low, high = basics[f"x{i}"]
        rows.append((c, n, mean, std, low, *points[f"x{i}"], high))
    schema = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def _per_column(df: DataFrame, aggregates: Sequence[Column], names: Sequence[str], extra: dict[str, Sequence]) -> DataFrame:
    """Turn one row of per-column aggregates into one row per column."""
    wide = df.agg(*[a.alias(f"v{i}") for i, a in enumerate(aggregates)])
    items = [
        F.struct(
            F.lit(name).alias("column"),
            *[F.lit(values[i]).alias(label) for label, values in extra.items()],
            F.col(f"v{i}").alias("value"),
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*items)))


def nonnull_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column."""
    types = [t for _, t in df.dtypes]
    counted = _per_column(df, [F.count(as_column(c)) for c in df.columns], df.columns, {"type": types})
    return counted.withColumnRenamed("value", "non_null")


def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact number of distinct non-null values of each column (text columns by default)."""
    cols = list(cols or columns_by_type(df)[1])
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), as_column(c).cast("string").alias("value")) for c in cols])
        )
    )
    found = long.distinct().groupBy("column").agg(F.count("value").alias("distinct_values"))
    return found


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(row_count().alias("rows"), F.lit(len(df.columns)).alias("columns"))
