"""The tables behind the plots: histogram, density curve, points, rankings, per-group series."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, number
from .aggregate import profile, row_count
from .clustering import KMeansFit, assign_clusters
from .projection import Projection, project
from .quantiles import exact_quantiles
from .relational import top_k


def histogram(df: DataFrame, c: str, *, bins: int | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum (the last one closed), empty bins included.
    Nulls and NaN are in no bin.

    Without ``bins`` the width follows the interquartile rule (2 IQR n^-1/3), not below half
    the square-root rule (range / sqrt n) and not above the logarithmic one (range / (log2 n + 1))."""
    x = number(c)
    n, low, high = df.agg(F.count(x), F.min(x), F.max(x)).first()
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([], "bin int, low double, high double, count bigint")
    if bins is None:
        q25, q75 = exact_quantiles(df, [c], [0.25, 0.75])[c]
        spread = max(2 * (q75 - q25) / n ** (1 / 3), (high - low) / math.sqrt(n) / 2)
        width = min(spread, (high - low) / (math.log2(n) + 1))
        bins = max(1, math.ceil((high - low) / width)) if width > 0 else 1
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    counted = df.where(x.isNotNull()).groupBy(place.alias("bin")).agg(row_count().alias("n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


#: Powers summed per bin. A row's error is at most 1.1 / (2^n sqrt(n!)) of the kernel's peak: 4e-12 for n = 16.
_POWERS = 16


def kernel_density(df: DataFrame, c: str, *, points: int = 200) -> DataFrame:
    """Gaussian density on an even grid from minimum to maximum, bandwidth std * n^(-1/5).

    Rows are summed up in bins one bandwidth wide: their number and the powers of their distance from the middle. The
    bins' Hermite series give the density to 11 digits of its highest possible value, so after one aggregation the work
    is bins times grid points, whatever the number of rows."""
    x = number(c)
    n, low, high, std = df.agg(F.count(x), F.min(x), F.max(x), F.stddev_samp(x)).first()
    spark = df.sparkSession
    if not n or not std:
        return spark.createDataFrame([], "x double, density double")
    width = std * n ** (-1 / 5)
    grid = np.linspace(low, high, points)
    weight = 1.0 / (n * width * math.sqrt(2 * math.pi))
    place = (x - F.lit(low)) / F.lit(width)
    placed = df.select(place.alias("z")).where("z is not null").select("z", F.floor("z").alias("bin"))
    placed = placed.select("bin", (F.col("z") - F.col("bin") - 0.5).alias("d"))
    power = [F.lit(1.0)]
    for _ in range(_POWERS - 1):
        power.append(power[-1] * F.col("d"))
    names = [f"s{i}" for i in range(_POWERS)]
    bins = placed.groupBy("bin").agg(*[F.sum(p).alias(s) for p, s in zip(power, names)])
    reach = (grid - low) / width

    def partial_sums(batches):
        total = np.zeros(len(grid))
        for batch in batches:
            sums = batch[names].to_numpy()
            for first in range(0, len(batch), 2048):
                part = sums[first : first + 2048]
                u = reach - (batch["bin"].to_numpy()[first : first + 2048, None] + 0.5)
                u = np.clip(u, -40.0, 40.0)  # nothing is left of a kernel so far away
                before, now, series, factor = np.zeros_like(u), np.ones_like(u), np.zeros_like(u), 1.0
                for i in range(len(names)):
                    series += now * (part[:, i : i + 1] / factor)
                    before, now = now, u * now - i * before
                    factor *= i + 1
                total += (series * np.exp(-0.5 * u * u)).sum(axis=0)
        yield pd.DataFrame({"x": grid, "density": total * weight})

    partials = bins.mapInPandas(partial_sums, "x double, density double")
    return partials.groupBy("x").agg(F.greatest(F.sum("density"), F.lit(0.0)).alias("density"))


def cluster_points(df: DataFrame, fit: KMeansFit, projection: Projection, *, key: str) -> DataFrame:
    """Key, component scores and cluster number of every row."""
    scored = assign_clusters(project(df, projection), fit)
    return scored.select(as_column(key), *[f"pc{j + 1}" for j in range(len(projection.loadings))], "cluster")


def explained_variance(df: DataFrame, projection: Projection) -> DataFrame:
    rows = [(f"pc{j + 1}", 100.0 * share) for j, share in enumerate(projection.explained)]
    return df.sparkSession.createDataFrame(rows, "component string, percent double")


def top_groups(df: DataFrame, by: str, *, size: str, above: int = 5, k: int = 15, ties: Sequence[str]) -> DataFrame:
    """The k best groups among those with more than ``above`` members."""
    return top_k(df.where(as_column(size) > above), by, k, ties=ties)


def series_by_group(df: DataFrame, group: str, step: str, *, size: str, mean: str) -> DataFrame:
    """Members and member-weighted mean per step of every group, all groups at once."""
    n, m = as_column(size), as_column(mean)
    weighted = F.try_divide(F.sum(m * n), F.sum(F.when(m.isNotNull(), n)))
    return profile(df, [group, step], F.sum(n).alias(size), weighted.alias(mean))
