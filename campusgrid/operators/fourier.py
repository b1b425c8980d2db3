"""A non-linear regressor that is linear in random waves of its inputs.

Cosines with seeded random frequencies and phases span smooth functions of all inputs together (their frequencies are
normal, so the fit approaches that of a Gaussian kernel). The waves are made inside the tasks, and one triangular factor
over them gives the ridge solution: a single pass whatever the number of rows, no learning rate, no epochs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import as_column
from ..session import ship_package
from .least_squares import solve, triangular_factor


def fourier_waves(dims: int, terms: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies (dims x terms) and phases. ``width``: the distance over which the function may change."""
    rng = np.random.default_rng(seed)
    return rng.standard_normal((dims, terms)) / width, rng.uniform(0.0, 2.0 * np.pi, terms)


class FourierModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    waves = Param(Params._dummy(), "waves", "frequencies, one input after the other", TypeConverters.toListFloat)
    phases = Param(Params._dummy(), "phases", "phase of every wave", TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "intercept, inputs, waves", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        phases, weights = (np.array(self.getOrDefault(p)) for p in (self.phases, self.weights))
        waves = np.array(self.getOrDefault(self.waves)).reshape(-1, len(phases))

        @F.arrow_udf(DoubleType())
        def predicted(column: pa.Array) -> pa.Array:
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
            plain = weights[0] + x @ weights[1 : 1 + x.shape[1]]
            return pa.array(plain + np.cos(x @ waves + phases) @ weights[1 + x.shape[1] :])

        return df.withColumn(self.getPredictionCol(), predicted(vector_to_array(as_column(self.getFeaturesCol()))))


class FourierRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge regression on the inputs and ``terms`` random waves of them, for inputs of about unit deviation.

    ``ridge`` is the penalty on all weights but the intercept, per row. The driver and every task hold
    (inputs + terms)^2 numbers."""

    terms = Param(Params._dummy(), "terms", "number of waves", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "distance over which the function may change", TypeConverters.toFloat)
    ridge = Param(Params._dummy(), "ridge", "penalty per row", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the waves", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, terms: int = 256, width: float = 1.0, ridge: float = 1e-6, seed: int = 42) -> None:
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(terms=256, width=1.0, ridge=1e-6, seed=42)

    def setFeaturesCol(self, value: str) -> FourierRegressor:
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str) -> FourierRegressor:
        return self._set(labelCol=value)

    def setPredictionCol(self, value: str) -> FourierRegressor:
        return self._set(predictionCol=value)

    def _fit(self, df: DataFrame) -> FourierModel:
        ship_package(df.sparkSession)
        inputs = vector_to_array(as_column(self.getFeaturesCol()))
        first = df.select(F.size(inputs)).first()
        if first is None:
            raise ValueError("no rows to fit on")
        dims, terms = first[0], self.getOrDefault(self.terms)
        waves, phases = fourier_waves(dims, terms, self.getOrDefault(self.width), self.getOrDefault(self.seed))

        def expand(rows: np.ndarray) -> np.ndarray:
            x = rows[:, :-1]
            return np.column_stack([np.ones(len(x)), x, np.cos(x @ waves + phases), rows[:, -1]])

        line = F.concat(inputs, F.array(as_column(self.getLabelCol()).cast("double")))
        factor = triangular_factor(df.select(line.alias("line")), "line", dims + terms + 2, expand)
        pull = np.sqrt(self.getOrDefault(self.ridge)) * abs(factor[0, 0])
        penalty = pull * np.eye(dims + terms + 2)[1:-1]
        found = solve(np.linalg.qr(np.concatenate([factor, penalty]), mode="r"))
        model = FourierModel()._set(waves=waves.reshape(-1).tolist(), phases=phases.tolist(), weights=found.coefficients.tolist())
        return self._copyValues(model)
