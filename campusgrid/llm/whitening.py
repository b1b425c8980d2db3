"""Whitening of embeddings by their leading principal components.

The covariance matrix is never formed: its leading eigenvectors come from Chebyshev-filtered subspace iteration. A
cycle multiplies a block of vectors by a polynomial of the covariance that stays below one on the unwanted end of
the spectrum and grows fast above it, orthonormalises the block and solves the small eigenproblem inside it
(Rayleigh-Ritz). One multiplication V Q is one pass over the rows: each task sums (x - mean)^T ((x - mean) Q) of its
rows and sends one row per dimension, so what is shuffled and collected depends on dimensions and block only.
Cycles end when the residuals |V q - e q| of all wanted pairs are at rounding level."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.shelf import prepare, save

#: Entries are read as floor(SCALE * c) + SHIFT; larger ones than LARGEST would not be whole numbers any more.
SCALE, SHIFT, LARGEST = 1024.0, 100_000, 2.0**40


def _floored(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, x): whole-number entries of the vectors that take part."""
    values = F.transform(F.col(f"`{vector_column}`"), lambda c: c.cast("double"))
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), values.alias("v"))
    fit = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", fit))
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x"))


def _packed(dims: int):
    """Entries of a row as the bytes of 64-bit integers; missing ones at the end count as zero entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            values, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
            x = np.full((batch.num_rows, dims), SHIFT, dtype=np.int64)
            x[np.arange(dims) < sizes[:, None]] = values
            yield pa.RecordBatch.from_arrays([batch.column("id"), _rows_of(x)], names=["id", "x"])

    return run


def _rows_of(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x)
    places = np.arange(len(x) + 1, dtype=np.int32) * x.itemsize * x.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(places), pa.py_buffer(x)])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(data, np.int64, len(column) * dims, int(at[0])).reshape(-1, dims)


def _whole_sum(values: np.ndarray, most: int) -> list[int]:
    """Exact sums over rows of whole numbers no larger than ``most``."""
    if len(values) * most < 1 << 62:
        return [int(s) for s in values.sum(axis=0)]
    return list(values.astype(object).sum(axis=0))


@dataclass(frozen=True)
class _Rows:
    """The packed rows with their number and exact sums per dimension."""

    frame: DataFrame
    dims: int
    n: int
    sums: tuple[int, ...]

    @property
    def mean(self) -> np.ndarray:
        """Of integers: whole part and remainder apart, so that centring loses nothing to the size of the mean."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def summed(self, make, width: int) -> np.ndarray:
        """Sum over tasks of the matrices that ``make(batches)`` returns, one row of ``width`` numbers per line."""
        names = [f"c{i}" for i in range(width)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = make(batch.column("x") for batch in batches)
            if total is not None:
                columns = [pa.array(np.arange(len(total)))] + [pa.array(np.ascontiguousarray(c)) for c in total.T]
                yield pa.RecordBatch.from_arrays(columns, names=["line", *names])

        schema = ", ".join(["line bigint", *[f"{c} double" for c in names]])
        parts = self.frame.select("x").mapInArrow(run, schema)
        table = parts.groupBy("line").agg(*[F.sum(c).alias(c) for c in names]).toArrow().to_pandas()
        return table.sort_values("line")[names].to_numpy()

    def times(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """V q and the diagonal of V: one pass."""
        dims, mean, rest = self.dims, self.mean, self.rest

        def make(columns):
            total = None
            for column in columns:
                x = (_matrix(column, dims) - mean) - rest
                part = np.column_stack([x.T @ (x @ q), (x * x).sum(axis=0)])
                total = part if total is None else total + part
            return total

        out = self.summed(make, q.shape[1] + 1) / self.n
        return out[:, :-1], out[:, -1]

    def projected_covariance(self, c: np.ndarray) -> np.ndarray:
        """Covariance of the rows projected on the columns of ``c``."""
        dims, mean, rest = self.dims, self.mean, self.rest

        def make(columns):
            total = None
            for column in columns:
                w = ((_matrix(column, dims) - mean) - rest) @ c
                part = np.column_stack([w.T @ w, w.sum(axis=0)])
                total = part if total is None else total + part
            return total

        out = self.summed(make, c.shape[1] + 1) / self.n
        return out[:, :-1] - np.outer(out[:, -1], out[:, -1])


def _rows(vectors: DataFrame, id_column: str, vector_column: str) -> _Rows | None:
    floored = _floored(vectors, id_column, vector_column)
    dims = floored.agg(F.max(F.size("x")).alias("w")).collect()[0]["w"] or 0
    if not dims:
        return None
    kind = floored.schema["id"].dataType.simpleString()
    frame = save(floored.mapInArrow(_packed(dims), f"id {kind}, x binary"), "whole_vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            n += len(x)
            sums = [a + b for a, b in zip(sums, _whole_sum(x, int(np.abs(x).max(initial=0))))]
        exact = pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims)), pa.array([n] * dims), exact], names=["dim", "n", "s"])

    parts = frame.mapInArrow(run, "dim bigint, n bigint, s decimal(38,0)")
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect()
    return _Rows(frame, dims, found[0]["n"], tuple(int(r["s"]) for r in found))


def _filtered(rows: _Rows, q: np.ndarray, z: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V, applied to q: at most about one in size for eigenvalues in [0, cut] against one at
    ``top``, where it is scaled to one. ``z`` is V q, the first step; every further degree is a pass."""
    half = cut / 2.0
    sigma = first = half / (top - half)
    before, now = q, (z - half * q) * (sigma / half)
    for _ in range(degree - 1):
        later = 1.0 / (2.0 / first - sigma)
        before, now = now, (rows.times(now)[0] - half * now) * (2.0 * later / half) - before * (sigma * later)
        sigma = later
    return now


def _ritz(q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors, and V times the vectors."""
    small = q.T @ z
    values, turn = np.linalg.eigh((small + small.T) / 2.0)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, z @ turn


def leading_eigenpairs(rows: _Rows, k: int, guard: int, seed: int, passes: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues of the covariance, their unit vectors as columns, and the trace."""
    block = min(rows.dims, k + guard)
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((rows.dims, block)))[0]
    z, diagonal = rows.times(q)
    used, trace = 1, float(diagonal.sum())
    small = 2e-14 * np.sqrt(rows.dims)
    while True:
        values, q, z = _ritz(q, z)
        wanted = min(k, block)
        gaps = np.linalg.norm(z[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
        if values[0] <= small * max(1.0, abs(trace)) or gaps.max() <= small * values[0] or block == rows.dims:
            return values[:wanted], q[:, :wanted], trace
        if used > passes:
            raise RuntimeError(f"residual {gaps.max() / values[0]:.2g} after {used} passes; raise guard or passes")
        cut = max(float(values[-1]), 1e-12 * float(values[0]))
        speed = np.arccosh(np.maximum(2.0 * values[[0, wanted - 1]] / cut - 1.0, 1.0))
        need = np.log(gaps.max() / (small * values[0])) + 2.0
        steps = need / max(float(speed[1]), 0.05)
        # Beyond this the first vectors would drown the others before the block is made orthonormal again.
        steps = min(steps, 18.0 / max(float(speed[0] - speed[1]), 1e-3), 24.0)
        degree = max(2, int(np.ceil(steps)))
        q = np.linalg.qr(_filtered(rows, q, z, cut, float(values[0]), degree))[0]
        z = rows.times(q)[0]
        used += degree


def _whitened(rows: _Rows, components: np.ndarray, values: np.ndarray, explained: np.ndarray, error: float):
    dims, n, mean, rest = rows.dims, rows.n, rows.mean, rows.rest
    rough = np.array([s - n * m for s, m in zip(rows.sums, mean.tolist())], dtype=np.int64)
    k = len(values)
    scaled = components / np.sqrt(values)

    def deviations(x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2 in whole numbers."""
        far = x - mean
        most = n * int(np.abs(far).max(initial=0)) + n
        if dims * most * most < 1 << 63:
            d = far * n - rough
            return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
        d = far.astype(object) * n - rough
        sums = [Decimal(int(s)) for s in (d * d).sum(axis=1)]
        return pa.array([s if s < 10**38 else None for s in sums], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            w = ((x - mean) - rest) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), deviations(x).take(each), pa.array(w.reshape(-1)),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(
    vectors: DataFrame, k: int = 8, *, id_column: str = "vec_id", vector_column: str = "embedding", guard: int = 24,
    seed: int = 1, passes: int = 2000,
) -> DataFrame:
    """Per vector and component 1..k: id, ``component``, ``n`` (vectors that take part), ``deviation`` (decimal, exact:
    n^2 times the squared distance from the mean), ``whitened`` (unit variance), ``explained`` (share of the trace), and
    ``identity_error``, the largest difference of the whitened covariance from the identity.

    An entry c is read as floor(1024 c) + 100000. Vectors that are null or hold a null, non-finite or huge (2^40 or
    more) entry take no part. Shorter vectors, empty ones too, are filled up with entries of zero. Every row counts,
    repeated rows and null ids too. Components without variance (fewer distinct rows than components, equal rows, one
    row) are left out; no rows, or none with variance, give no rows. Of equal eigenvalues any basis is returned. Signs:
    a component's largest entry is positive. A deviation of 10^38 or more is null. Extra columns are not looked at.

    The driver and each task hold dims x (k + guard) numbers; ``guard`` vectors beyond k make the filter steeper."""
    spark = vectors.sparkSession
    prepare(spark)
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = _rows(vectors, id_column, vector_column)
    if rows is None or not rows.n or not k:
        return spark.createDataFrame([], schema)
    values, components, trace = leading_eigenpairs(rows, k, guard, seed, passes)
    some = values > max(1e-10 * values[0], 1e-18)
    values, components = values[some], components[:, some]
    if not len(values):
        return spark.createDataFrame([], schema)
    high = np.abs(components).argmax(axis=0)
    components = components * np.sign(components[high, np.arange(len(values))])
    found = rows.projected_covariance(components / np.sqrt(values))
    error = float(np.abs(found - np.eye(len(values))).max())
    return rows.frame.mapInArrow(_whitened(rows, components, values, values / trace, error), schema)
