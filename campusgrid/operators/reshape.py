"""Pivots from detail rows to columns, and dummy columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, present
from .aggregate import profile


def observed_values(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values of category columns, found in one job.

    They become column names, so more of them than Spark's own pivot limit is an error."""
    if not cols:
        return {}
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(i).alias("i"), as_column(c).cast("string").alias("v")) for i, c in enumerate(cols)])
        )
    )
    rows = long.where("v is not null").distinct().limit(limit * len(cols) + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in cols}
    for row in rows:
        found[cols[row.i]].append(row.v)
    for c, values in found.items():
        if len(values) > limit:
            raise ValueError(f"column {c} has more than {limit} values; it cannot become columns")
        values.sort()
    return found


def count_pivot(
    df: DataFrame,
    key: str | Sequence[str],
    c: str,
    *,
    values: Sequence[str] | None = None,
    prefix: str = "",
    blank_as_null: bool = False,
) -> DataFrame:
    """Rows per key and value of ``c``, one column per value, 0 where there is none.

    Keys whose ``c`` is always null do not appear. Without ``values`` the columns are all
    values found, in order."""
    column = F.nullif(as_column(c), F.lit("")) if blank_as_null else as_column(c)
    keys = [key] if isinstance(key, str) else list(key)
    if values is None:
        values = observed_values(df.select(column.alias("v")), ["v"])["v"]
    text = column.cast("string")
    # Conditional counts combine on the map side, so one shuffle by key does, hot keys included.
    rows = df.where(as_column(c).isNotNull() & text.isNotNull())
    if not values:
        return rows.where(present(rows, keys)).select(*[as_column(k) for k in keys]).distinct()
    return profile(rows, keys, *[F.count_if(text == F.lit(v)).alias(prefix + v) for v in values])


def mean_or_zero(c: str | Column, value: str, measure: str | Column) -> Column:
    """Aggregate: mean of the measure over rows with this value; 0 when the group has no such
    row, null when it has but without a measure, or when ``c`` is null in the whole group."""
    column, measure = as_column(c), as_column(measure)
    hit = column == F.lit(value)
    return (
        F.when(F.count(column) == 0, F.lit(None).cast("double"))
        .when(F.count_if(hit) == 0, F.lit(0.0))
        .otherwise(F.avg(F.when(hit, measure)))
    )


def mean_pivot(
    df: DataFrame,
    index: Sequence[str],
    c: str,
    measure: str,
    values: Sequence[str],
    *,
    absent_as_zero: bool = False,
    prefix: str = "",
) -> DataFrame:
    """Mean of the measure per index and value of ``c``, one column per value.

    An absent combination is null, or 0 with ``absent_as_zero``. Rows with nothing but
    null cells are dropped; so are rows with a null in the index."""
    if absent_as_zero:
        cells = [mean_or_zero(c, v, measure).alias(prefix + v) for v in values]
        return profile(df.where(as_column(c).isNotNull()), index, *cells)
    cells = [F.avg(F.when(as_column(c) == v, as_column(measure))).alias(prefix + v) for v in values]
    return profile(df, index, *cells).dropna(how="all", subset=[prefix + v for v in values])


def dummies(
    df: DataFrame,
    cols: Sequence[str],
    *,
    drop_first: bool = True,
    values: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Replace each category column by 0/1 columns ``<column>_<value>`` in value order, the
    first one left out by default; a null gives all zeros."""
    values = values or observed_values(df, cols)
    flags = [
        F.coalesce((as_column(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in cols
        for v in (values[c][1:] if drop_first else values[c])
    ]
    return df.select(*[as_column(c) for c in df.columns if c not in cols], *flags)
