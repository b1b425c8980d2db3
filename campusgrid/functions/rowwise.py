"""Row-wise arithmetic with skip-null rules, and the deterministic hash bucket."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .codes import as_column


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Sum over columns; nulls count as 0, so an all-null row gives 0."""
    return reduce(add, [F.coalesce(as_column(c), F.lit(0)) for c in cols])


def row_mean(cols: Sequence[str | Column]) -> Column:
    """Mean over the non-null columns; an all-null row gives null."""
    values = [as_column(c).cast("double") for c in cols]
    total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values])
    present = reduce(add, [v.isNotNull().cast("int") for v in values])
    return F.try_divide(total, present)


def safe_ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom as double; a zero or null denominator gives null."""
    return F.try_divide(as_column(top).cast("double"), as_column(bottom).cast("double"))


def abs_error(actual: str | Column, predicted: str | Column) -> Column:
    return F.abs(as_column(actual) - as_column(predicted))


def category_interaction(category: str | Column, level: str, measure: str | Column) -> Column:
    """(category == level) as 0/1, times the measure; a null category counts as 0."""
    hit = F.coalesce((as_column(category) == level).cast("int"), F.lit(0))
    return hit * as_column(measure)


def product_interaction(a: str | Column, b: str | Column) -> Column:
    return as_column(a) * as_column(b)


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Stable bucket of a key in 0..buckets-1: first 8 hex digits of its md5; a null key has the
    bucket of the empty text. Depends on the key only, never on partitioning or run."""
    text = F.coalesce(as_column(key).cast("string"), F.lit(""))
    head = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def number(c: str | Column) -> Column:
    """A value as double; NaN counts as missing, like null."""
    value = as_column(c).cast("double")
    return F.when(~F.isnan(value), value)


def present(df: DataFrame, cols: Sequence[str]) -> Column:
    """Condition that all columns hold a value; NaN counts as missing. Plain null tests, so
    they reach the file scan."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    tests = [as_column(c).isNotNull() for c in cols] + [~F.isnan(as_column(c)) for c in cols if c in floats]
    return reduce(and_, tests)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN in floating-point columns into null, so both mean 'missing'."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    if not floats:
        return df
    return df.select(
        *[
            F.when(~F.isnan(as_column(c)), as_column(c)).alias(c) if c in floats else as_column(c)
            for c in df.columns
        ]
    )
