"""Programme impact: regression, counterfactual uplift, coefficients, scored report, and the
further models on the same table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from ..functions import as_column, category_interaction, product_interaction, row_mean
from ..operators.columns import columns_by_type, drop_columns
from ..operators.inference import OlsResult, fit_ols
from ..operators.regression import RegressionRun, coefficient_table, fit_regression, run_report, uplift
from ..operators.selection import compare_nested, lasso_cv
from ..session import keep
from . import names as N

TARGET = "promedio_logro"


@dataclass(frozen=True)
class ImpactStudy:
    run: RegressionRun
    uplift: DataFrame
    coefficients: DataFrame
    report: DataFrame
    cached: DataFrame

    def release(self) -> None:
        """Drop the cached rows once the frames have been used."""
        self.cached.unpersist()


def labelled_table(table: DataFrame, *, subjects: Sequence[str] = N.SUBJECTS_PANEL, target: str = TARGET) -> DataFrame:
    """Rows with at least one subject score, and their mean as the target."""
    return table.withColumn(target, row_mean(subjects)).where(as_column(target).isNotNull())


def impact_study(
    table: DataFrame,
    *,
    key: str = N.SITE,
    treatment: str = "QM",
    year: int | None = 2024,
    ids: Sequence[str] = ("Cod_Local", "COD_MOD"),
) -> ImpactStudy:
    """Fit on the training rows, and estimate the effect of the treatment on the test rows.
    Ids and subject scores are no features."""
    rows = table if year is None else table.where(as_column("AÑO") == year)
    data = drop_columns(labelled_table(rows), [*N.SUBJECTS_PANEL, *ids])
    data = keep(data)
    numbers, texts = columns_by_type(data, exclude=[key, TARGET])
    run = fit_regression(data, TARGET, numbers, texts, key=key)
    return ImpactStudy(
        run=run,
        uplift=uplift(run.model, run.test, treatment),
        coefficients=coefficient_table(run),
        report=run_report(run, key=key),
        cached=data,
    )


def interaction_model(table: DataFrame) -> OlsResult:
    """Least squares with size and programme interactions."""
    return fit_ols(
        labelled_table(table),
        f"{TARGET} ~ TALUMNO * TDOCENTE + QM * PDL + DAREACENSO",
        [TARGET, "TALUMNO", "TDOCENTE", "QM", "PDL", "DAREACENSO"],
    )


def select_features(table: DataFrame, features: Sequence[str], *, key: str = N.SITE) -> DataFrame:
    return lasso_cv(labelled_table(table), features, TARGET, key=key)


def nonlinear_run(table: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], *, key: str = N.SITE) -> RegressionRun:
    """Boosted trees in the regressor slot."""
    model = GBTRegressor(seed=42)
    return fit_regression(labelled_table(table), TARGET, num_cols, cat_cols, key=key, model=model)


def progressive_comparison(table: DataFrame, *, treatment: str = "QM") -> DataFrame:
    """Treatment alone, then with context, capacity and interactions."""
    data = labelled_table(table).withColumns(
        {
            f"{treatment}_x_URBANO": category_interaction("DAREACENSO", "Urbana", treatment),
            f"{treatment}_x_ALUMNO": product_interaction("TALUMNO", treatment),
        }
    )
    alone = [treatment]
    context = [*alone, "DAREACENSO", N.DISTANCE, "ID_TERR"]
    capacity = [*context, "TALUMNO", "TDOCENTE", "NROCED"]
    crossed = [*capacity, f"{treatment}_x_URBANO", f"{treatment}_x_ALUMNO"]
    return compare_nested(
        data,
        [("M1", alone), ("M2", context), ("M3", capacity), ("M4", crossed)],
        TARGET,
        focus=treatment,
    )
