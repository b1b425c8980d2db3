"""The whole study: load, integrate, segment, label, regress; results as frames and files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import as_column, row_mean
from ..operators.columns import columns_by_type, drop_columns
from ..operators.regression import RegressionRun, fit_regression
from ..operators.relational import left_join
from ..session import keep
from ..sources import load_any, write_csv
from . import names as N
from .segments import Segments, segment, segment_sizes, site_features
from .sites import integrate_sites

_ORDER = "_load_order"


@dataclass(frozen=True)
class StudyResult:
    sites: DataFrame
    segments: Segments
    sizes: DataFrame
    regression: RegressionRun

    def release(self) -> None:
        """Drop the cached rows once the frames have been used."""
        self.segments.release()
        self.sites.unpersist()


def _texts(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def load_sources(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The five sources from any supported format. Codes stay text."""
    register = StructType(
        [StructField(c, LongType() if c in ("TALUM", "TDOC") else StringType()) for c in N.REGISTER]
    )
    return {
        "register": load_any(spark, paths["register"], schema=register, order_col=_ORDER),
        "classrooms": load_any(spark, paths["classrooms"], schema=_texts(N.CLASSROOMS)),
        "buildings": load_any(spark, paths["buildings"], schema=_texts(N.BUILDINGS)),
        "history": load_any(spark, paths["history"], schema=_texts(N.HISTORY), order_col=_ORDER),
        "distances": load_any(
            spark,
            paths["distances"],
            schema=StructType.fromDDL(f"`{N.SITE}` string, `{N.DISTANCE}` double"),
        ),
    }


def label_and_fit(sites: DataFrame, labels: DataFrame) -> RegressionRun:
    """Join the segment to each site by key, build the target and fit the regression. The
    segment is a category; sites without one get the most frequent in preprocessing."""
    base = drop_columns(sites, N.UNUSED)
    tagged = left_join(base, labels.withColumn("cluster", F.col("cluster").cast("string")), N.SITE)
    scores = list(N.SUBJECTS.values())
    data = tagged.withColumn("target", row_mean(scores)).where("target is not null")
    data = drop_columns(data, scores)
    numbers, texts = columns_by_type(data, exclude=[N.SITE, "target"])
    return fit_regression(data.where(as_column(N.SITE).isNotNull()), "target", numbers, texts, key=N.SITE)


def run_study(sources: Mapping[str, DataFrame], *, k: int = 4, output: str | None = None) -> StudyResult:
    """Integrate and analyse loaded sources. With ``output`` the site table and the segment of
    every site are written as CSV below it."""
    sites = keep(
        integrate_sites(
            sources["register"],
            sources["classrooms"],
            sources["buildings"],
            sources["history"],
            sources["distances"],
            register_order=[_ORDER],
            history_order=[_ORDER],
        )
    )
    known = sites.where(as_column(N.SITE).isNotNull())
    segments = segment(site_features(known), N.SEGMENT_FEATURES, key=N.SITE, k=k)
    if output:
        write_csv(sites, f"{output}/sites")
        write_csv(segments.labels, f"{output}/segments")
    return StudyResult(sites, segments, segment_sizes(segments.labels), label_and_fit(known, segments.labels))
