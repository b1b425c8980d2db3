"""School segments: features, standardising, elbow, k-means, profile and component points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, row_sum, safe_ratio, yes_no
from ..operators.clustering import KMeansFit, assign_clusters, cluster_profile, fit_kmeans_grid
from ..operators.prepare import ZScalerModel, zscore
from ..operators.projection import Projection, fit_pca
from ..operators.reports import cluster_points
from ..session import keep
from . import names as N


@dataclass(frozen=True)
class Segments:
    labels: DataFrame
    elbow: DataFrame
    profile: DataFrame
    points: DataFrame
    fit: KMeansFit
    scaler: ZScalerModel
    projection: Projection
    cached: DataFrame

    def release(self) -> None:
        """Drop the cached rows once the frames have been used."""
        self.cached.unpersist()


def site_features(sites: DataFrame) -> DataFrame:
    """Students per teacher and infrastructure index for the integrated site table. A building
    state that does not occur counts as 0."""
    parts = [c for c in N.INFRA if c in sites.columns]
    return sites.withColumns(
        {"ratio_alumno_docente": safe_ratio("TALUM", "TDOC"), "infra_index": row_sum(parts)}
    )


def master_features(master: DataFrame) -> DataFrame:
    """The same two features for the master table, whose infrastructure columns hold SI / NO."""
    coded = master.withColumns({c: yes_no(c) for c in N.INFRA_YES_NO})
    return coded.withColumns(
        {"ratio_alumno_docente": safe_ratio("TALUMNO", "TDOCENTE"), "infra_index": row_sum(N.INFRA_YES_NO)}
    )


def segment(
    df: DataFrame,
    features: Sequence[str],
    *,
    key: str,
    k: int = 4,
    k_max: int = 10,
    starts: int = 10,
    seed: int = 42,
) -> Segments:
    """Cluster the rows that are complete in all features. The key stays beside every label;
    rows left out simply have no label, so a left join gives them null."""
    scaled, scaler = zscore(df.select(as_column(key), *[as_column(c) for c in features]), features)
    scaled = keep(scaled)
    fits = fit_kmeans_grid(scaled, features, sorted({*range(2, k_max + 1), k}), key=key, starts=starts, seed=seed)
    fit = fits[k]
    projection = fit_pca(scaled, features)
    labelled = assign_clusters(scaled, fit)
    raw = labelled.select(
        as_column(key),
        *[(as_column(c) * s + m).alias(c) for c, m, s in zip(features, scaler.getOrDefault(scaler.means), scaler.getOrDefault(scaler.scales))],
        "cluster",
    )
    return Segments(
        labels=labelled.select(as_column(key), "cluster"),
        elbow=df.sparkSession.createDataFrame(
            [(n, f.inertia) for n, f in sorted(fits.items()) if n <= k_max], "k int, inertia double"
        ),
        profile=cluster_profile(raw, features),
        points=cluster_points(scaled, fit, projection, key=key),
        fit=fit,
        scaler=scaler,
        projection=projection,
        cached=scaled,
    )


def segment_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "cluster")
