"""Regression runs: split, preprocessing, fit, metrics, coefficients, uplift and scored report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import abs_error, as_column, number, present
from ..session import keep
from .boosting import fit_merged, merges_rows
from .prepare import build_preprocessor, hash_split, observed_columns, split_side
from .relational import concat_rows
from .reshape import observed_values


@dataclass(frozen=True)
class RegressionRun:
    model: PipelineModel
    target: str
    train: DataFrame
    test: DataFrame
    metrics: DataFrame
    rows: DataFrame
    segment: Column


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2 and mean absolute error in one pass."""
    y, p = as_column(actual), as_column(predicted)
    pairs = df.where(y.isNotNull()).select(number(y).alias("y"), number(p).alias("p")).where("y is not null and p is not null")
    sums = pairs.agg(
        F.sum((F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))).alias("res"),
        (F.var_pop("y") * F.count("y")).alias("tot"),
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
        F.count("y").alias("n"),
    )
    r2 = F.when(F.col("tot") == 0, F.when(F.col("res") == 0, 1.0).otherwise(0.0)).otherwise(
        1.0 - F.try_divide(F.col("res"), F.col("tot"))
    )
    return sums.select(r2.alias("r2"), "mae", "n")


def fit_regression(
    df: DataFrame,
    target: str,
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    *,
    key: str,
    model: Estimator | None = None,
    test_size: float = 0.2,
) -> RegressionRun:
    """Fit preprocessing and a regressor on the training rows, score the rest.

    Any pyspark.ml regressor fits the slot; the default is plain least squares, solved
    from one pass of moments. Boosted trees learn from merged rows where these are far fewer
    (see ``boosting``). Columns without a single training value are left out."""
    labelled = df.where(present(df, [target])).withColumn(target, as_column(target).cast("double"))
    train, test = hash_split(labelled, key, test_size=test_size)
    regressor = (model or LinearRegression(regParam=0.0)).copy()
    regressor = regressor.setFeaturesCol("features").setLabelCol(target).setPredictionCol("prediction")
    # The preparation steps read the training rows several times.
    rows = keep(train.select(*[as_column(c) for c in (*num_cols, *cat_cols)], as_column(target)))
    try:
        usable = set(observed_columns(rows, [*num_cols, *cat_cols]))
        # One-hot slots are held on the driver; too many values of a category are an error.
        values = observed_values(rows, [c for c in cat_cols if c in usable])
        numbers = [c for c in num_cols if c in usable]
        prepared = build_preprocessor(numbers, [*values]).fit(rows)
        fitted = fit_merged(regressor, prepared, rows, numbers, values, target) if merges_rows(regressor) else None
        fitted = fitted or [regressor.fit(prepared.transform(rows).select("features", target))]
    finally:
        rows.unpersist()
    whole = PipelineModel(stages=[*prepared.stages, *fitted])
    metrics = regression_metrics(predict(whole, test), target, "prediction")
    return RegressionRun(whole, target, train, test, metrics, labelled, split_side(key, test_size=test_size))


def predict(model: PipelineModel, df: DataFrame, *, name: str = "prediction") -> DataFrame:
    """The frame with the prediction added, working columns removed."""
    scored = model.transform(df)
    value = F.col("prediction").alias(name)
    return scored.select(*[as_column(c) for c in df.columns if c != name], value)


def _feature_names(model: PipelineModel, sample: DataFrame) -> list[str]:
    """Names of the vector slots, read from schema metadata (no job runs)."""
    shown = PipelineModel(stages=model.stages[:-1]).transform(sample)
    groups = shown.schema["features"].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [a["name"].replace("__scaled", "").replace("__hot_", "_") for a in slots]


def coefficient_table(run: RegressionRun) -> DataFrame:
    """Feature and coefficient, on the scale of the prepared (standardised) inputs."""
    names = _feature_names(run.model, run.train)
    values = run.model.stages[-1].coefficients.toArray()
    rows = [(name, float(v)) for name, v in zip(names, values)]
    return run.train.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def uplift(model: PipelineModel, df: DataFrame, treatment: str, *, off: float = 0.0, on: float = 1.0) -> DataFrame:
    """Mean difference between predictions with the treatment on and off for every row.
    Both scenarios are scored in one pass over the rows."""
    kind = df.schema[treatment].dataType
    arms = df.withColumn("_on", F.explode(F.array(F.lit(False), F.lit(True))))
    arms = arms.withColumn(
        treatment, F.when(F.col("_on"), F.lit(on).cast(kind)).otherwise(F.lit(off).cast(kind))
    )
    scored = predict(model, arms)
    without = F.avg(F.when(~F.col("_on"), F.col("prediction")))
    with_it = F.avg(F.when(F.col("_on"), F.col("prediction")))
    return scored.agg(
        without.alias("mean_without"), with_it.alias("mean_with"), (with_it - without).alias("uplift")
    )


def scored_report(
    parts: Sequence[tuple[str, DataFrame]], *, key: str, actual: str, predicted: str = "prediction"
) -> DataFrame:
    """Key, segment, actual, prediction and absolute error of several scored frames."""
    return concat_rows(
        [
            scored.select(
                as_column(key),
                F.lit(segment).alias("segment"),
                as_column(actual).alias("actual"),
                as_column(predicted).alias("prediction"),
                abs_error(actual, predicted).alias("abs_error"),
            )
            for segment, scored in parts
        ]
    )


def run_report(run: RegressionRun, *, key: str) -> DataFrame:
    """Both sides of the split, read and scored in one pass."""
    scored = predict(run.model, run.rows).withColumn("segment", run.segment)
    return scored.select(
        as_column(key),
        "segment",
        as_column(run.target).alias("actual"),
        "prediction",
        abs_error(run.target, "prediction").alias("abs_error"),
    )


def simple_regression(df: DataFrame, target: str, feature: str) -> DataFrame:
    """Slope, intercept and r2 of a one-feature fit, as plain aggregates."""
    y, x = as_column(target), as_column(feature)
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )
