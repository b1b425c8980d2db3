"""Dedup, joins, ranking and frequency operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, present


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by the given order (which should be unique within a key).
    Null keys form one group.

    An aggregate rather than a window: each task keeps one row per key before the
    shuffle, so a key holding a third of the table never lands in one task."""
    keys = _names(key)
    others = [c for c in df.columns if c not in keys]
    ranking = F.struct(*[as_column(c) for c in order])
    payload = F.struct(*[as_column(c).alias(f"c{i}") for i, c in enumerate(others)])
    if not others:
        return df.select(*[as_column(k) for k in keys]).distinct()
    first = df.groupBy(*[as_column(k) for k in keys]).agg(F.min_by(payload, ranking).alias("_row"))
    place = {c: i for i, c in enumerate(others)}
    return first.select(
        *[
            as_column(c) if c in keys else F.col(f"_row.c{place[c]}").alias(c)
            for c in df.columns
        ]
    )


def require_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fail when a (non-null) key repeats; returns the frame for chaining. Runs one job."""
    keys = _names(key)
    repeated = df.where(present(df, keys)).groupBy(*[as_column(k) for k in keys]).count().where("count > 1")
    example = repeated.take(1)
    if example:
        raise ValueError(f"key {keys} is not unique, e.g. {example[0].asDict()}")
    return df


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str | tuple[str, str]],
    *,
    null_safe: bool = False,
    suffix: str = "_right",
) -> DataFrame:
    """Left outer equi-join.

    ``on`` holds shared names, or (left, right) pairs whose two columns are both kept.
    Other right columns that collide get ``suffix``. No broadcast is forced: adaptive
    execution broadcasts a side only after measuring it, and splits hot left keys."""
    pairs = [(p, p) if isinstance(p, str) else tuple(p) for p in ([on] if isinstance(on, str) else on)]
    shared = {r for l, r in pairs if l == r}
    taken = set(left.columns)
    keys = [f"_join_key_{i}" for i in range(len(pairs))]
    renamed = right.select(
        *[as_column(r).alias(k) for k, (_, r) in zip(keys, pairs)],
        *[
            as_column(c).alias(c + suffix if c in taken else c)
            for c in right.columns
            if c not in shared
        ],
    )
    tests = [
        as_column(l).eqNullSafe(F.col(k)) if null_safe else as_column(l) == F.col(k)
        for k, (l, _) in zip(keys, pairs)
    ]
    return left.join(renamed, reduce(lambda a, b: a & b, tests), "left").drop(*keys)


def star_join(base: DataFrame, dims: Sequence[DataFrame], key: str, *, check: bool = False) -> DataFrame:
    """base left-joined to every dimension on one key; each dimension has one row per key, which
    ``check`` makes sure of (one job for each).

    The dimensions are merged first (unique keys, so no fan-out and no skew) and the big
    side then takes part in a single join, which adaptive execution can split at hot keys.
    In a chain of joins on one key it could not."""
    if not dims:
        return base
    if check:
        for dim in dims:
            require_unique(dim, key)
    merged = reduce(lambda a, b: a.join(b, key, "full"), [d.where(as_column(key).isNotNull()) for d in dims])
    return base.join(merged, key, "left").select(
        *[as_column(c) for c in base.columns],
        *[as_column(c) for d in dims for c in d.columns if c != key],
    )


def distinct_join(left: DataFrame, rights: Sequence[tuple[DataFrame, str | Sequence[str | tuple[str, str]]]]) -> DataFrame:
    """Distinct rows of a chain of many-to-many left joins that keep all columns.

    distinct(A join B) equals distinct(A) join distinct(B) when every column is kept, so
    each input is deduplicated (with partial aggregation) before the join. The fan-out is
    then bounded by the distinct combinations, not by the row counts, and the wide joined
    rows need no second shuffle."""
    out = left.distinct()
    for right, on in rights:
        out = left_join(out, right.distinct(), on)
    return out


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Frequencies of a column, nulls left out, most frequent first (ties by value)."""
    counted = df.where(as_column(c).isNotNull()).groupBy(as_column(c)).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), as_column(c))


def top_k(df: DataFrame, by: str, k: int, *, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest measure; null measures are left out, ties follow ``ties``."""
    return (
        df.where(as_column(by).isNotNull())
        .orderBy(as_column(by).desc(), *[as_column(t) for t in ties])
        .limit(k)
    )


def concat_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Vertical concatenation by column name; a column missing in one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
