"""Vectors against a stated set of queries.

All rows stay where they are stored; the queries come to them in rounds of bounded size, each broadcast to all tasks.
A task keeps the best rows it has seen for each query of the round and sends these at its end, so what is shuffled are
results only, and neither side is copied for every part of the other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries of a round, and bytes of their vectors at most.
QUERY_ROWS, QUERY_BYTES = 8192, 1 << 25


def usable(vectors: DataFrame, id_column: str, vector_column: str, zero: bool) -> DataFrame:
    """(id, vec) of vectors that are not null or empty and hold finite numbers only, one per id; ``zero``: also
    all-zero ones. Of rows with one id the vector that sorts first counts; rows without an id take no part."""
    values = F.transform(F.col(f"`{vector_column}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), values.alias("vec"))
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)
    rows = rows.where(F.col("id").isNotNull() & (F.size("vec") > 0) & F.forall("vec", finite))
    if not zero:
        rows = rows.where(F.exists("vec", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def width(rows: DataFrame) -> int:
    """The longest vector's length; shorter ones are filled up with zeros. 0 without rows."""
    return rows.agg(F.max(F.size("vec")).alias("w")).collect()[0]["w"] or 0


def padded(rows: DataFrame, dims: int) -> DataFrame:
    short = F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vec")))
    return rows.withColumn("vec", F.when(F.size("vec") < dims, short).otherwise(F.col("vec")))


def dealt(rows: DataFrame, name: str, size: int, count: int, *columns: str) -> DataFrame:
    """Rows gathered into ceil(count / size) groups ``name`` (0, 1, ...) as ``<name>_members``, ordered by id."""
    groups = max(1, -(-count // size))
    key = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias(name)
    members = F.array_sort(F.collect_list(F.struct("id", "vec", *columns)))
    return rows.select(key, "id", "vec", *columns).groupBy(name).agg(members.alias(f"{name}_members"))


def query_rounds(asked: DataFrame, count: int, dims: int, *columns: str) -> Iterator[tuple[np.ndarray, np.ndarray, list[list]]]:
    """(ids, matrix, further columns) of the queries, a bounded number at a time, in order of id."""
    size = max(1, min(QUERY_ROWS, QUERY_BYTES // (8 * max(1, dims))))
    rounds = max(1, -(-count // size))
    for number in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == number).select("id", "vec", *columns).orderBy("id").toArrow()
        if part.num_rows:
            vectors = part["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            yield part["id"].to_numpy(), vectors.reshape(part.num_rows, -1), [part[c].to_pylist() for c in columns]


class Best:
    """The ``k`` best rows of each query so far: largest ``worth``, ties to the smaller id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.query, self.id, self.worth = np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def add(self, query: np.ndarray, ids: np.ndarray, worth: np.ndarray) -> None:
        """``query``: places of the queries in their round."""
        query, ids = np.concatenate([self.query, query]), np.concatenate([self.id, ids])
        worth = worth if self.worth is None else np.concatenate([self.worth, worth])
        order = np.lexsort((ids, -worth, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        order = order[place < self.k]
        self.query, self.id, self.worth = query[place < self.k], ids[order], worth[order]


def members(column: pa.Array, row: int) -> tuple[pa.StructArray, np.ndarray, np.ndarray]:
    """The members of one row: the struct array, their ids and their vectors as a matrix."""
    found = column.slice(row, 1).flatten()
    ids = found.field("id").to_numpy(zero_copy_only=False)
    vectors = found.field("vec").flatten().to_numpy(zero_copy_only=False)
    return found, ids, vectors.reshape(len(ids), -1)


def ranked(found: DataFrame, k: int, best: Column) -> DataFrame:
    """The first ``k`` per query_id by ``best``, ties to the smaller vec_id, as ``rank`` from 1.

    Each task sends at most k rows per query. They are cut to k per lane before the last ranking, so a query's rows of
    many tasks do not meet in one place at once."""
    pick = F.array_sort(F.collect_list(F.struct(best.alias("order"), "vec_id", "score")))
    lanes = found.withColumn("lane", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    first = lanes.groupBy("query_id", "lane").agg(F.slice(pick, 1, k).alias("top")).select("query_id", F.explode("top").alias("t"))
    second = first.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list("t")), 1, k).alias("top"))
    return second.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id", "t.score"
    )
