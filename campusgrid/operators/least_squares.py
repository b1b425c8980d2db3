"""Least squares without normal equations: a tree of orthogonal factors.

Every task reduces its rows to the triangular factor R of its part of the matrix; factors are stacked and reduced again,
a few at a time, until one is left. R holds all that least squares needs and keeps twice the digits that cross products
would. Its rank is read off at the end: collinear columns get the solution of smallest norm."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column
from ..session import keep, ship_package

#: Factors that one task stacks, and rows it reduces at a time.
_FAN, _ROWS = 8, 4096


def _reduced(parts: Sequence[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def _leaf(width: int, expand):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = None
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at in range(0, len(x), max(_ROWS, 2 * width)):
                part = x[at : at + max(_ROWS, 2 * width)]
                part = part if expand is None else expand(part)
                factor = _reduced([part] if factor is None else [factor, part])
        if factor is not None:
            node = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([factor.tobytes()])], names=["node", "factor"])

    return run


def _merge(width: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        factors = [np.frombuffer(f).reshape(-1, width) for f in table["factor"].to_pylist()]
        node = table["node"][0].as_py() // _FAN
        return pa.table({"node": pa.array([node], pa.int64()), "factor": pa.array([_reduced(factors).tobytes()])})

    return run


def triangular_factor(rows: DataFrame, column: str, width: int, expand=None) -> np.ndarray:
    """R of the matrix whose rows are the arrays in ``column``, as a ``width`` x ``width`` matrix. ``expand`` turns rows
    into wider ones inside the tasks.

    Bounded in width, which the driver and every task hold the square of; rows may be any number."""
    ship_package(rows.sparkSession)
    arrays = rows.select(as_column(column).alias("x"))
    nodes = keep(arrays.mapInArrow(_leaf(width, expand), "node bigint, factor binary"))
    try:
        last = nodes.agg(F.max("node")).first()[0]
        if last is None:
            return np.zeros((width, width))
        tree = nodes
        while last:
            tree = tree.groupBy(F.floor(F.col("node") / _FAN).alias("_parent")).applyInArrow(_merge(width), "node bigint, factor binary")
            last //= _FAN
        factor = np.frombuffer(tree.first()["factor"]).reshape(-1, width)
    finally:
        nodes.unpersist()
    out = np.zeros((width, width))
    out[: len(factor)] = factor
    return out


@dataclass(frozen=True)
class Solution:
    """Coefficients in the order of the columns, their covariance up to the residual variance, and sums of squares."""

    coefficients: np.ndarray
    spread: np.ndarray
    rank: int
    residual: float
    total: float

    @property
    def r2(self) -> float:
        return 1.0 - self.residual / self.total if self.total > 0 else 0.0


def solve(factor: np.ndarray, used: Sequence[int] | None = None, tol: float = 1e-10) -> Solution:
    """Least squares for the last column of a factor of [1, columns..., target] on the intercept and the ``used``
    columns (all without it). ``total``: the target's squares about its mean.

    Columns are scaled before the rank is decided, so units do not matter; ``tol`` is relative to the largest singular
    value. With less than full rank the coefficients are those of smallest norm, as the pseudo-inverse gives them."""
    width = len(factor)
    columns = [0, *(range(1, width - 1) if used is None else [u + 1 for u in used])]
    x, y = factor[:, columns], factor[:, -1]
    scale = np.linalg.norm(x, axis=0)
    scale[scale == 0] = 1.0
    u, s, vt = np.linalg.svd(x / scale, full_matrices=False)
    rank = int((s > tol * s[0]).sum()) if len(s) and s[0] > 0 else 0
    beta = (vt[:rank].T @ ((u[:, :rank].T @ y) / s[:rank])) / scale
    root = (vt[:rank].T / s[:rank]) / scale[:, None]
    spread = root @ root.T
    if rank < len(columns):
        free = np.linalg.qr(vt[rank:].T / scale[:, None])[0]
        for _ in range(2):  # the second time takes away what rounding left of large parts
            beta = beta - free @ (free.T @ beta)
            spread = spread - free @ (free.T @ spread)
            spread = spread - (spread @ free) @ free.T
    residual = float(((y - x @ beta) ** 2).sum())
    total = float((y[1:] ** 2).sum())
    return Solution(beta, spread, rank, residual, total)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or tiny)
    out = d
    for m in range(1, 1000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + step * d or tiny)
            c = 1.0 + step / c or tiny
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def two_sided_p(t: float, freedom: int) -> float:
    """Odds of a value as far from zero under Student's distribution."""
    if freedom <= 0 or math.isnan(t):
        return math.nan
    return incomplete_beta(freedom / 2.0, 0.5, freedom / (freedom + t * t)) if math.isfinite(t) else 0.0
