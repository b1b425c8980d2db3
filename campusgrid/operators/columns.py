"""Frame-level column work: renames that fail loudly, lenient and strict drops, conforming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import as_column


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")


def prefix_columns(df: DataFrame, prefix: str, *, except_for: Sequence[str] = ()) -> DataFrame:
    """Put ``prefix`` before every column name that is not listed."""
    return df.select(
        *[as_column(c).alias(c if c in except_for else prefix + c) for c in df.columns]
    )


def rename_expected(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by an explicit map and fail if an expected column is absent."""
    require_columns(df, list(names))
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, cols: Sequence[str], *, strict: bool = False) -> DataFrame:
    """Drop columns; ``strict`` raises KeyError for a name that is not there."""
    if strict:
        require_columns(df, cols)
    return df.drop(*cols)


def conform_columns(df: DataFrame, cols: Sequence[str], *, fill: int = 0) -> DataFrame:
    """Exactly these columns in this order; one that is absent becomes the constant ``fill``."""
    return df.select(
        *[as_column(c) if c in df.columns else F.lit(fill).cast("bigint").alias(c) for c in cols]
    )


def columns_by_type(df: DataFrame, *, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, text) column names, ids and other excluded names left out."""
    fields = [f for f in df.schema if f.name not in exclude]
    return (
        [f.name for f in fields if isinstance(f.dataType, NumericType)],
        [f.name for f in fields if isinstance(f.dataType, StringType)],
    )
