"""Boosted trees on merged rows.

A tree tells rows apart only by the bins of their features, at most ``maxBins`` of each, so rows of the same bins share a leaf in
every tree. With squared loss their number and mean target give each split the same gain and each leaf the same value as the rows
themselves. They are merged in one pass, and the many passes of the learner read cells: at most bins^numbers x categories,
however many rows there are and however many values a column has."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column
from ..session import keep
from .prepare import BinnerModel

_COUNTED = 10_000
_CELLS_A_TASK = 50_000


def merges_rows(model) -> bool:
    """Whether weighted means stand for the rows: squared loss, each row in every tree, no minimum of rows in a node."""
    return (
        isinstance(model, GBTRegressor)
        and model.getLossType() == "squared"
        and model.getSubsamplingRate() == 1.0
        and model.getMinInstancesPerNode() == 1
        and not any(model.isDefined(p) for p in (model.weightCol, model.validationIndicatorCol))
    )


def fit_merged(
    model: GBTRegressor, prepared: PipelineModel, rows: DataFrame, num_cols: Sequence[str], values: Mapping[str, Sequence[str]], target: str
) -> list[Transformer] | None:
    """The stages that follow ``prepared``, or None where cells are not sure to be half the rows or fewer.

    ``values``: the category columns and their values."""
    if not num_cols and not values:
        return None
    scaled, binned = [f"{c}__scaled" for c in num_cols], [f"{c}__bin" for c in num_cols]
    indexed, hot = [f"{c}__index" for c in values], [f"{c}__hot" for c in values]
    ready = prepared.transform(rows)
    bins = model.getMaxBins()
    n, *distinct = ready.agg(F.count(F.lit(1)), *[F.approx_count_distinct(as_column(c)) for c in scaled]).first()
    most = math.prod(min(bins, d) for d in distinct) * math.prod(len(v) for v in values.values())
    if 2 * most > n:
        return None
    binner = BinnerModel()._set(inputCols=scaled, outputCols=binned, edges=bin_edges(ready, scaled, distinct, bins))
    cells = keep(
        binner.transform(ready)
        .groupBy(*[as_column(c) for c in (*binned, *indexed)])
        .agg(F.count(F.lit(1)).cast("double").alias("cell__rows"), F.avg(as_column(target)).alias(target))
    )
    try:
        encoded = cells
        for stage in prepared.stages:
            if isinstance(stage, OneHotEncoderModel):
                encoded = stage.transform(encoded)
        assembler = VectorAssembler(inputCols=[*binned, *hot], outputCol="binned")
        learner = model.copy().setFeaturesCol("binned").setWeightCol("cell__rows")
        few = assembler.transform(encoded).select("binned", as_column(target), "cell__rows").coalesce(1 + most // _CELLS_A_TASK)
        return [binner, assembler, learner.fit(few)]
    finally:
        cells.unpersist()


def bin_edges(df: DataFrame, cols: Sequence[str], distinct: Sequence[int], bins: int) -> list[list[float]]:
    """Edges between at most ``bins`` bins of about equal rows, from all rows.

    ``distinct``: about how many values a column has. The values of a column with few are counted; of the others the quantiles are
    taken, within a ten-thousandth of the rows."""
    found: list[list[float]] = [[] for _ in cols]
    counted = [i for i, d in enumerate(distinct) if d <= _COUNTED]
    if counted:
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), as_column(cols[i]).alias("v")) for i in counted])
        counts = df.select(F.inline(pairs)).groupBy("i", "v").count().sort("i", "v").collect()
        for i in counted:
            found[i] = even_edges([r["v"] for r in counts if r["i"] == i], [r["count"] for r in counts if r["i"] == i], bins)
    others = [i for i in range(len(cols)) if i not in counted]
    if others:
        ranks = [k / bins for k in range(1, bins)]
        cuts = df.agg(*[F.percentile_approx(as_column(cols[i]), ranks, 10_000) for i in others]).first()
        for i, cut in zip(others, cuts):
            found[i] = sorted(set(cut))
    return found


def even_edges(values: Sequence[float], counts: Sequence[int], bins: int) -> list[float]:
    """Midpoints between ascending values: all of them if there are at most ``bins`` values, else
    those nearest to equal shares of the rows. This is the tree learner's own rule for the rows it draws."""
    middles = ((np.array(values[:-1]) + np.array(values[1:])) / 2).tolist()
    if len(values) <= bins:
        return middles
    share = sum(counts) / bins
    edges, seen = [], 0
    for middle, count, following in zip(middles, counts, counts[1:]):
        seen += count
        wanted = share * (len(edges) + 1)
        if abs(seen - wanted) < abs(seen + following - wanted):
            edges.append(middle)
    return edges
