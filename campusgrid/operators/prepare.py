"""Fitted preparation steps as pyspark.ml stages: median and mode imputation, z-scores,
one-hot encoding, and the preprocessing chain put together from them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, hash_bucket, present
from .quantiles import column_modes, exact_quantiles


class _ColumnwiseModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A model holding one or more numbers per column, kept as params so that it saves."""

    def _rewrite(self, df: DataFrame, make) -> DataFrame:
        outputs = {o: make(i, as_column(c)) for i, (c, o) in enumerate(zip(self.getInputCols(), self.getOutputCols()))}
        return df.withColumns(outputs) if outputs else df


class _ColumnwiseEstimator(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        given = self._input_kwargs
        self._set(**{k: v for k, v in given.items() if v is not None})

    def _columns(self) -> tuple[list[str], list[str]]:
        inputs = list(self.getInputCols())
        return inputs, list(self.getOutputCols()) if self.isDefined(self.outputCols) and self.isSet(self.outputCols) else inputs


class MedianImputerModel(_ColumnwiseModel):
    medians = Param(Params._dummy(), "medians", "fill value per column, NaN for none", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = self.getOrDefault(self.medians)

        def fill(i, column):
            number = column.cast("double")
            observed = F.when(~F.isnan(number), number)
            return observed if math.isnan(values[i]) else F.coalesce(observed, F.lit(values[i]))

        return self._rewrite(df, fill)


class MedianImputer(_ColumnwiseEstimator):
    """Fill nulls and NaN of numeric columns with the exact median."""

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        inputs, outputs = self._columns()
        found = exact_quantiles(df, inputs, [0.5])
        medians = [math.nan if found[c][0] is None else float(found[c][0]) for c in inputs]
        model = MedianImputerModel()
        return model._set(inputCols=inputs, outputCols=outputs, medians=medians)


class ModeImputerModel(_ColumnwiseModel):
    modes = Param(Params._dummy(), "modes", "fill value per column", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = self.getOrDefault(self.modes)
        return self._rewrite(df, lambda i, column: F.coalesce(column.cast("string"), F.lit(values[i])))


class ModeImputer(_ColumnwiseEstimator):
    """Fill nulls of text columns with the most frequent value, smallest among equals."""

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        inputs, outputs = self._columns()
        found = column_modes(df, inputs)
        model = ModeImputerModel()
        return model._set(inputCols=inputs, outputCols=outputs, modes=[found[c] or "" for c in inputs])


class ZScalerModel(_ColumnwiseModel):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "population deviation per column, 1 when constant", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        means, scales = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        return self._rewrite(df, lambda i, column: (column.cast("double") - means[i]) / scales[i])


class ZScaler(_ColumnwiseEstimator):
    """Z-scores with the population deviation; a constant column is only centred."""

    def _fit(self, df: DataFrame) -> ZScalerModel:
        inputs, outputs = self._columns()
        aggregates = []
        for c in inputs:
            x = as_column(c).cast("double")
            aggregates += [F.avg(x), F.stddev_pop(x)]
        row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first()
        means = [float(m) if m is not None else 0.0 for m in row[0::2]]
        scales = [float(s) if s else 1.0 for s in row[1::2]]
        model = ZScalerModel()
        return model._set(inputCols=inputs, outputCols=outputs, means=means, scales=scales)


class BinnerModel(_ColumnwiseModel):
    """Numbers of the bins that values fall in, as doubles. An edge belongs to the bin below it."""

    edges = Param(Params._dummy(), "edges", "ascending edges between the bins, per column", TypeConverters.toListListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        edges = self.getOrDefault(self.edges)
        # Null and NaN stay, for the assembler to reject.
        return self._rewrite(df, lambda i, x: F.when(x.isNull() | F.isnan(x), x).otherwise(_edges_below(x, edges[i])))


def _edges_below(x: Column, edges: Sequence[float], first: int = 0) -> Column:
    """``first`` plus the number of edges below x, by halving."""
    if not edges:
        return F.lit(float(first))
    half = len(edges) // 2
    return F.when(x <= edges[half], _edges_below(x, edges[:half], first)).otherwise(
        _edges_below(x, edges[half + 1 :], first + half + 1)
    )


def zscore(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, ZScalerModel]:
    """Drop rows with a null in ``cols`` and replace these columns by z-scores; all other
    columns, the key among them, stay beside them."""
    complete = df.where(present(df, cols))
    model = ZScaler(inputCols=list(cols)).fit(complete)
    return model.transform(complete), model


def impute_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return MedianImputer(inputCols=list(cols)).fit(df).transform(df)


def impute_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ModeImputer(inputCols=list(cols)).fit(df).transform(df)


def hash_split(df: DataFrame, key: str, *, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: the same rows in every run and on any cluster. Every
    row is on one side; rows without a key share a bucket."""
    side = split_side(key, test_size=test_size)
    return df.where(side == "train"), df.where(side == "test")


def split_side(key: str, *, test_size: float = 0.2) -> Column:
    """'test' or 'train' for a row's key."""
    return F.when(hash_bucket(key, 10_000) < round(test_size * 10_000), "test").otherwise("train")


def build_preprocessor(
    num_cols: Sequence[str], cat_cols: Sequence[str], *, features_col: str = "features"
) -> Pipeline:
    """Median + z-score for numbers, mode + one-hot for text, assembled into one vector.

    One-hot keeps every category; a category not seen in fitting gives all zeros. The
    input columns are left as they are, so a fitted chain can score changed inputs."""
    stages, parts = [], []
    if num_cols:
        filled = [f"{c}__filled" for c in num_cols]
        scaled = [f"{c}__scaled" for c in num_cols]
        stages += [
            MedianImputer(inputCols=list(num_cols), outputCols=filled),
            ZScaler(inputCols=filled, outputCols=scaled),
        ]
        parts += scaled
    if cat_cols:
        filled = [f"{c}__filled" for c in cat_cols]
        indexed = [f"{c}__index" for c in cat_cols]
        hot = [f"{c}__hot" for c in cat_cols]
        stages += [
            ModeImputer(inputCols=list(cat_cols), outputCols=filled),
            StringIndexer(inputCols=filled, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        parts += hot
    stages.append(VectorAssembler(inputCols=parts, outputCol=features_col))
    return Pipeline(stages=stages)


def observed_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns with at least one non-null value; the others carry nothing to fit on."""
    if not cols:
        return []
    row = df.agg(*[F.count(as_column(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for c, n in zip(cols, row) if n]
