"""Writing results: CSV with a header, or Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from ..functions import as_column


def write_csv(
    df: DataFrame, path: str, *, separator: str = ",", encoding: str = "UTF-8", mode: str = "overwrite"
) -> None:
    """One CSV part per partition, each with the header; nulls are empty fields."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


#: Rows of a bucket: what a task that writes or reads it sorts or groups.
BUCKET_ROWS = 500_000


def bucket_count(frames: Iterable[DataFrame], *, least: int = 8) -> int:
    """Buckets for tables that are joined with each other: BUCKET_ROWS rows of the largest in each, ``least`` at least."""
    return max(least, *[-(-df.count() // BUCKET_ROWS) for df in frames])


def write_bucketed(
    df: DataFrame, path: str, name: str, key: str | Sequence[str], *, buckets: int, mode: str = "overwrite"
) -> DataFrame:
    """A table (``name`` in the catalogue, files at ``path``) whose rows are dealt into buckets by ``key`` and sorted by it.

    Joins and aggregates on the key then read the table as it lies: neither side of a join of two tables with as many
    buckets is shuffled, and of other tables only the other side is. Rows are dealt before they are written, so every
    bucket is one file. Choose buckets so that one fits a task's memory (``bucket_count``); a hot key stays in one."""
    keys = [key] if isinstance(key, str) else list(key)
    dealt = df.repartition(buckets, *[as_column(k) for k in keys])
    dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
