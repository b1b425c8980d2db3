"""Principal components of standardised columns, with the projected points kept beside the key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column
from ..session import keep, ship_package


@dataclass(frozen=True)
class Projection:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    loadings: tuple[tuple[float, ...], ...]
    explained: tuple[float, ...]


def _spread(rows: DataFrame, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Covariance (times the number of rows) applied to a block of vectors, and its diagonal as last column: one pass.

    A task adds up its rows and sends one line per column of the table."""
    names = [f"v{i}" for i in range(block.shape[1] + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(names)))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean))
            for at in range(0, len(x), 4096):
                part = x[at : at + 4096] - mean
                total[:, :-1] += part.T @ (part @ block)
                total[:, -1] += (part * part).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(mean))), *map(pa.array, np.ascontiguousarray(total.T))], names=["line", *names])

    parts = rows.mapInArrow(run, ", ".join(["line bigint", *[f"{n} double" for n in names]]))
    table = parts.groupBy("line").agg(*[F.sum(n).alias(n) for n in names]).toArrow().to_pandas()
    return table.sort_values("line")[names].to_numpy()


def fit_pca(
    df: DataFrame, cols: Sequence[str], components: int = 2, *, block: int = 64, seed: int = 42, tol: float = 1e-10,
    max_passes: int = 200,
) -> Projection:
    """Components and their share of the variance. Each component is signed so that its
    largest loading is positive.

    The range of the covariance is found from a random block of ``block`` vectors, which is multiplied by the covariance
    (a pass over the rows) and made orthonormal until the wanted components stay put; so no square of the columns is
    held anywhere, and tables of up to ``block`` columns, or of that rank, need a single multiplication and a check."""
    if not 0 < components <= len(cols):
        raise ValueError(f"{components} components of {len(cols)} columns")
    ship_package(df.sparkSession)
    rows = keep(df.select(F.array(*[as_column(c).cast("double") for c in cols]).alias("x")))
    try:
        means = rows.select(F.posexplode("x")).groupBy("pos").agg(F.avg("col").alias("m")).orderBy("pos").collect()
        if not means:
            raise ValueError("no rows to project")
        mean, width = np.array([r["m"] for r in means], dtype=float), min(len(cols), max(block, 2 * components))
        rng = np.random.default_rng(seed)
        q = np.eye(len(cols)) if width == len(cols) else np.linalg.qr(rng.standard_normal((len(cols), width)))[0]
        for _ in range(max_passes):
            found = _spread(rows, mean, q)
            z, trace = found[:, :-1], float(found[:, -1].sum())
            values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
            values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
            vectors = q @ turn
            gap = np.linalg.norm(z @ turn - vectors * values, axis=0).max()
            if width == len(cols) or gap <= tol * max(trace, 1e-300):
                break
            q = np.linalg.qr(z)[0]
        else:
            raise RuntimeError(f"components still move by {gap / trace:.1e} after {max_passes} passes; raise block or tol")
    finally:
        rows.unpersist()
    high = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[high, np.arange(components)] < 0, -1.0, 1.0)
    shares = values / trace if trace > 0 else np.zeros(components)
    return Projection(tuple(cols), tuple(map(float, mean)), tuple(tuple(map(float, v)) for v in vectors.T), tuple(map(float, shares)))


def project(df: DataFrame, fit: Projection) -> DataFrame:
    """Add pc1, pc2, ... as plain column arithmetic."""
    centred = [as_column(c) - F.lit(m) for c, m in zip(fit.columns, fit.means)]
    return df.withColumns(
        {
            f"pc{j + 1}": reduce(add, [x * F.lit(w) for x, w in zip(centred, weights)])
            for j, weights in enumerate(fit.loadings)
        }
    )
