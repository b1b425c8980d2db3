"""Exact top-k inner products in three phases with a uniform threshold.

A score is a sum over ``lists`` blocks of dimensions, each of which gives every vector a partial score.

1. Every shard of vectors takes the k best of each list and resolves their whole scores; a task sends the k best it
   has seen of each query. The k-th best of all that were sent is a safe cutoff of its query: at least k vectors
   reach it.
2. The cutoff goes out with the query. A shard whose norms cannot make up the cutoff is passed over. Partial scores
   count from the shard's smallest one in each list, so they are not negative, and a vector whose partial scores all
   lie below cutoff / lists (in these terms) cannot reach the cutoff. Entries at or above that uniform threshold are
   collected.
3. A collected vector whose known entries and the threshold for the others stay below the cutoff goes; the scores of
   the rest, and of no others, are summed up exactly, and their k best are merged.

Components are whole numbers, floor(scale * x). Sums are exact: in double precision as long as they must stay below
2**53, else in 64-bit integers (scores that do not fit in 64 bits are out of range)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.grid import Best, padded, query_rounds, ranked, usable, width
from campusgrid.llm.shelf import prepare, save, tidy

SHARD_ROWS, BLOCK_ROWS, LISTS = 8192, 256, 4
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _edges(dims: int, lists: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, dims, lists + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _parts(queries: np.ndarray, vectors: np.ndarray, lists: int) -> list[np.ndarray]:
    """Partial scores, one queries x vectors matrix for each list."""
    top = max(np.abs(queries).max(initial=0), 1) * max(np.abs(vectors).max(initial=0), 1) * queries.shape[1]
    kind = np.float64 if top < 2.0**53 else np.int64
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    return [queries[:, a:b] @ vectors[:, a:b].T for a, b in _edges(queries.shape[1], lists)]


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of up to ``rows`` rows of a task at a time."""
    ids, vectors, have = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            ids.append(part.column("id").to_numpy(zero_copy_only=False))
            vectors.append(part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
            have += part.num_rows
            if have >= rows:
                yield np.concatenate(ids), np.concatenate(vectors)
                ids, vectors, have = [], [], 0
    if have:
        yield np.concatenate(ids), np.concatenate(vectors)


def _leading(parts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: (query, vector) places of the k + 1 best of every list (one may be the query itself)."""
    kept = np.zeros(parts[0].shape, dtype=bool)
    few = min(k + 1, kept.shape[1])
    for part in parts:
        np.put_along_axis(kept, np.argpartition(part, -few, axis=1)[:, -few:], True, axis=1)
    return np.nonzero(kept)


def _sufficient(parts: list[np.ndarray], cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phases 2 and 3: places of the entries at or above the threshold whose bound reaches the cutoff."""
    low = [p.min(axis=1) for p in parts]
    need = cutoff - sum(x.astype(cutoff.dtype) for x in low)
    threshold = -(-need // len(parts))  # partial scores are whole numbers
    bound, some = np.zeros(parts[0].shape, dtype=parts[0].dtype), np.zeros(parts[0].shape, dtype=bool)
    for part, least in zip(parts, low):
        above = part - least[:, None]
        seen = above >= threshold[:, None]
        some |= seen
        bound += np.where(seen, above, threshold[:, None])
    return np.nonzero(some & (bound >= need[:, None]))


def _scan(asked, k: int, lists: int):
    """``asked``: a round's ids, vectors and, from the second phase on, cutoffs (null: all rows are wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, cutoffs = asked.value
        best = Best(k)
        sides = _edges(queries.shape[1], lists)
        lengths = [np.linalg.norm(queries[:, a:b].astype(np.float64), axis=1) for a, b in sides]
        for ids, vectors in _shards(batches, SHARD_ROWS):
            reach = sum(x * np.linalg.norm(vectors[:, a:b].astype(np.float64), axis=1).max() for x, (a, b) in zip(lengths, sides))
            for at in range(0, len(query_ids), BLOCK_ROWS):
                block = np.arange(at, min(at + BLOCK_ROWS, len(query_ids)))
                if cutoffs is not None:
                    block = np.array([q for q in block if cutoffs[q] is None or reach[q] * (1 + 1e-9) + 1 >= cutoffs[q]], dtype=np.int64)
                if not len(block):
                    continue
                parts = _parts(queries[block], vectors, lists)
                if cutoffs is None:
                    q, v = _leading(parts, k)
                else:
                    bounds = [cutoffs[i] for i in block]
                    open_ = np.array([c is None for c in bounds])
                    q, v = np.nonzero(np.broadcast_to(open_[:, None], parts[0].shape))
                    if not open_.all():
                        limited = np.flatnonzero(~open_)
                        more = _sufficient([p[limited] for p in parts], np.array([bounds[i] for i in limited], dtype=np.int64))
                        q, v = np.concatenate([q, limited[more[0]]]), np.concatenate([v, more[1]])
                other = ids[v] != query_ids[block[q]]
                q, v = q[other], v[other]
                best.add(block[q], ids[v], sum(p[q, v].astype(np.int64) for p in parts))
        scores = best.worth if best.worth is not None else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(query_ids[best.query]), pa.array(best.id), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return run


def _searched(rows: DataFrame, asked: DataFrame, count: int, dims: int, k: int, lists: int, name: str, *columns: str) -> DataFrame:
    """The k best of every query after all rounds."""
    spark, found = rows.sparkSession, None
    for ids, vectors, more in query_rounds(asked, count, dims, *columns):
        shared = spark.sparkContext.broadcast((ids, vectors, more[0] if more else None))
        part = save(ranked(rows.mapInArrow(tidy(_scan(shared, k, lists)), _FOUND), k, -F.col("score")), name)
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int, scale: float = 256.0, id_column: str = "vec_id",
    vector_column: str = "embedding", lists: int = LISTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores against all other vectors, ties to the smaller
    id. ``is_query`` is a condition on the column ``id``.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id; of
    several rows with one id one counts. Shorter vectors are filled up with zeros. A query without another vector,
    and an empty table, give no rows. Every round of queries reads the stored vectors twice."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = usable(vectors, id_column, vector_column, zero=True)
    rows = save(rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("bigint"))), "vectors")
    dims, count = width(rows), rows.count()
    rows = padded(rows, dims)
    asked = rows.where(is_query)
    asked = save(asked, "queries")
    asked_count = asked.count()
    if not asked_count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sent = _searched(rows, asked, asked_count, dims, k, lists, "sent")
    # The k-th best of what the tasks sent; fewer than k in all mean no cutoff.
    sent = sent.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff"))
    limited = save(asked.join(sent, "id", "left"), "cutoffs")
    return _searched(rows, limited, asked_count, dims, k, lists, "found", "cutoff")
