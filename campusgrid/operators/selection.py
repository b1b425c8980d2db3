"""Model choice from moments: cross-validated lasso and nested model comparison."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, hash_bucket, present
from ..session import keep
from .least_squares import solve, triangular_factor
from .prepare import MedianImputer, ZScaler
from .reshape import dummies, observed_values
from .wide_lasso import wide_lasso_cv


def moments(
    df: DataFrame, cols: Sequence[str], *, group: str | None = None, max_width: int = 2000
) -> dict[int, np.ndarray]:
    """Cross-product matrix of [1, cols...] per group, from one pass.

    A task adds up its own matrix and sends one packed upper triangle per group, so what
    is shuffled depends on the number of columns, not of rows. More columns than
    ``max_width`` are an error, as every task holds the square of their number. Rows with a
    null group belong to none."""
    cols = list(cols)
    size = len(cols) + 1
    if len(cols) > max_width:
        raise ValueError(f"{len(cols)} columns exceed max_width={max_width}")
    upper = np.triu_indices(size)
    ready = df.select(
        (as_column(group) if group else F.lit(0)).cast("int").alias("_g"),
        *[as_column(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
    )

    ready = ready.where("_g is not null")

    def partial_products(batches):
        totals = {}
        for batch in batches:
            values = np.column_stack([np.ones(len(batch)), batch.drop(columns="_g").to_numpy(dtype=float)])
            groups = batch["_g"].to_numpy()
            for g in np.unique(groups):
                part = values[groups == g]
                totals[g] = totals.get(g, 0.0) + part.T @ part
        for g, total in totals.items():
            yield pd.DataFrame({"g": int(g), "spot": np.arange(len(upper[0])), "v": total[upper]})

    rows = (
        ready.mapInPandas(partial_products, "g int, spot int, v double")
        .groupBy("g", "spot")
        .agg(F.sum("v").alias("v"))
        .toArrow()
        .to_pandas()
    )
    out = {}
    for g, part in rows.groupby("g"):
        matrix = np.zeros((size, size))
        packed = np.zeros(len(upper[0]))
        packed[part["spot"].to_numpy()] = part["v"].to_numpy()
        matrix[upper] = packed
        out[int(g)] = matrix + np.triu(matrix, 1).T
    return out


def _centred(matrix: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, covariance) from a cross-product matrix."""
    n = matrix[0, 0]
    means = matrix[0, 1:] / n
    return n, means, matrix[1:, 1:] / n - np.outer(means, means)


def _lasso_path(cov: np.ndarray, target: np.ndarray, alphas: np.ndarray, max_iter: int, tol: float) -> list[np.ndarray]:
    """Coordinate descent on the covariance, largest penalty first, each start from the last."""
    weights = np.zeros(len(target))
    path = []
    for alpha in alphas:
        for _ in range(max_iter):
            biggest = 0.0
            for j in range(len(weights)):
                if cov[j, j] <= 1e-12:
                    continue
                pull = target[j] - cov[j] @ weights + cov[j, j] * weights[j]
                new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / cov[j, j]
                biggest = max(biggest, abs(new - weights[j]))
                weights[j] = new
            if biggest <= tol:
                break
        path.append(weights.copy())
    return path


def lasso_cv(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    *,
    key: str,
    folds: int = 5,
    alphas: int = 100,
    ratio: float = 1e-3,
    max_iter: int = 10_000,
    tol: float = 1e-6,
    max_width: int = 2000,
) -> DataFrame:
    """Lasso on standardised features with the penalty chosen by cross-validation.

    Every fold and penalty is solved from the per-fold moments of a single data pass; the
    held-out error also follows from the moments. Folds are hash buckets of the key. Nulls
    are filled with medians; a text feature becomes dummies without its first level. One row
    per (dummy) feature with its coefficient and whether it stays. More columns than ``max_width`` go to
    ``wide_lasso_cv``, which gives the same without their square."""
    used = df.where(present(df, [target])).select(
        hash_bucket(key, folds).alias("_fold"),
        as_column(target).cast("double").alias(target),
        *[as_column(f) if dict(df.dtypes)[f] == "string" else as_column(f).cast("double").alias(f) for f in features],
    )
    texts = [f for f in features if dict(df.dtypes)[f] == "string"]
    if texts:
        values = used.agg(*[F.count_distinct(as_column(f)).alias(f"n{i}") for i, f in enumerate(texts)]).first()
        if len(features) + sum(values) > max_width:
            return wide_lasso_cv(df, features, target, key=key, folds=folds, alphas=alphas, ratio=ratio, max_active=max_width)
        levels = observed_values(used, texts)
        used = dummies(used, texts, values=levels)
        features = [s for f in features for s in ([f"{f}_{v}" for v in levels[f][1:]] if f in texts else [f])]
    used = keep(used)
    try:
        filled = MedianImputer(inputCols=list(features)).fit(used).transform(used)
        scaled = ZScaler(inputCols=list(features)).fit(filled).transform(filled)
        per_fold = moments(scaled, [*features, target], group="_fold")
    finally:
        used.unpersist()
    whole = sum(per_fold.values())
    _, means, cov = _centred(whole)
    top = float(np.abs(cov[:-1, -1]).max())
    grid = np.geomspace(top, top * ratio, alphas) if top > 0 else np.array([0.0])
    error = np.zeros(len(grid))
    for held in per_fold.values():
        n, centre, part = _centred(whole - held)
        path = _lasso_path(part[:-1, :-1], part[:-1, -1], grid, max_iter, tol)
        for a, w in enumerate(path):
            line = np.concatenate([[centre[-1] - centre[:-1] @ w], w, [-1.0]])
            error[a] += (line @ held @ line) / held[0, 0] / len(per_fold)
    best = int(error.argmin())
    weights = _lasso_path(cov[:-1, :-1], cov[:-1, -1], grid[: best + 1], max_iter, tol)[-1]
    rows = [(f, float(w), bool(w != 0), float(grid[best])) for f, w in zip(features, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, selected boolean, alpha double")


def compare_nested(
    df: DataFrame,
    steps: Sequence[tuple[str, Sequence[str]]],
    target: str,
    *,
    focus: str,
) -> DataFrame:
    """In-sample R2 and the coefficient of one feature for a series of feature lists.

    Text features become dummies without their first level. All models are solved from columns of one triangular
    factor over the rows that are complete for every step; collinear features share the coefficients of smallest norm."""
    wanted = list(dict.fromkeys(f for _, features in steps for f in features))
    texts = [f for f in wanted if dict(df.dtypes)[f] == "string"]
    numbers = [f for f in wanted if f not in texts]
    data = df.select(*[as_column(f) for f in wanted], as_column(target).cast("double").alias("_target"))
    data = data.where(present(data, [*numbers, "_target"]))
    levels = observed_values(data, texts) if texts else {}
    wide = dummies(data, texts, values=levels) if texts else data
    slots = {f: [f] for f in numbers} | {f: [f"{f}_{v}" for v in levels[f][1:]] for f in texts}
    order = [s for f in wanted for s in slots[f]]
    line = F.array(F.lit(1.0), *[as_column(c).cast("double") for c in [*order, "_target"]])
    factor = triangular_factor(wide.select(line.alias("line")), "line", len(order) + 2)
    rows = []
    for name, features in steps:
        used = [order.index(s) for f in features for s in slots[f]]
        found = solve(factor, used)
        at = [order[u] for u in used]
        rows.append((name, found.r2, float(found.coefficients[1 + at.index(focus)]) if focus in at else 0.0))
    return df.sparkSession.createDataFrame(rows, "model string, r2 double, coefficient double")
