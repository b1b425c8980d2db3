"""Ordinary least squares by formula, with the usual statistics."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, present
from .least_squares import solve, triangular_factor, two_sided_p


@dataclass(frozen=True)
class OlsResult:
    terms: DataFrame
    fit: DataFrame


def _aliases(variables: Sequence[str]) -> list[str]:
    """Names that a formula can hold, whatever the columns are called."""
    return [f"v{i}v" for i in range(len(variables))]


def _plain_formula(formula: str, variables: Sequence[str]) -> str:
    """The formula with every variable (quoted with backticks or not) replaced by its alias;
    of names that overlap the longest one counts."""
    alias = dict(zip(variables, _aliases(variables)))
    names = sorted(variables, key=len, reverse=True)
    word = lambda n: rf"(?<![\w.]){re.escape(n)}(?![\w.])" if re.fullmatch(r"[\w.]+", n) else re.escape(n)
    pattern = "|".join([*[re.escape(f"`{n}`") for n in names], *map(word, names)])
    return re.sub(pattern, lambda m: alias[m[0].strip("`")], formula) if names else formula


def fit_ols(df: DataFrame, formula: str, variables: Sequence[str]) -> OlsResult:
    """Least squares for an R-style formula (``*``, ``:`` and ``^`` allowed), solved by a tree of orthogonal factors.

    ``variables`` are the columns in the formula, under any names (``dist+1``, ``QM DIRECTO``);
    rows with a null or NaN in one are dropped. Text
    columns become treatment dummies without their first level; in interactions they keep all
    levels, so some of their terms repeat a main effect. Collinear terms are allowed: they get the coefficients of
    smallest norm, and degrees of freedom count the rank. Terms: coefficient,
    standard error, t and p. Fit: R2, adjusted R2, F, log-likelihood, AIC and BIC."""
    spark = df.sparkSession
    data = df.where(present(df, variables)).select(*[as_column(v).alias(a) for v, a in zip(variables, _aliases(variables))])
    encoder = RFormula(formula=_plain_formula(formula, variables), stringIndexerOrderType="alphabetDesc").fit(data)
    design = encoder.transform(data)
    groups = design.schema["features"].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    names = [re.sub(r"(^|:)v(\d+)v", lambda m: m[1] + variables[int(m[2])], a["name"]) for a in slots]
    line = F.concat(F.array(F.lit(1.0)), vector_to_array("features"), F.array(F.col("label").cast("double")))
    factor = triangular_factor(design.select(line.alias("line")), "line", len(names) + 2)
    n = round(float(factor[0, 0] ** 2))
    found = solve(factor)
    width, residual_df = found.rank - 1, n - found.rank
    variance = found.residual / residual_df if residual_df > 0 else math.nan
    errors = [math.sqrt(max(v, 0.0)) for v in np.diag(found.spread) * variance]
    terms = []
    for name, value, error in zip(["Intercept", *names], found.coefficients.tolist(), errors):
        t = value / error if error > 0 else math.copysign(math.inf, value)
        terms.append((name, value, error, t, two_sided_p(t, residual_df)))
    r2, rss = found.r2, found.residual
    loglik = -n / 2 * (math.log(2 * math.pi) + math.log(rss / n) + 1) if rss > 0 else math.inf
    f_value = (r2 / width) / ((1 - r2) / residual_df) if r2 < 1 and residual_df > 0 and width else math.inf
    adjusted = 1 - (1 - r2) * (n - 1) / residual_df if residual_df > 0 else math.nan
    fit = (
        n, width, residual_df, r2, adjusted, f_value, loglik, 2 * (width + 1) - 2 * loglik, math.log(max(n, 1)) * (width + 1) - 2 * loglik
    )
    return OlsResult(
        spark.createDataFrame([*terms[1:], terms[0]], "term string, coefficient double, std_error double, t double, p double"),
        spark.createDataFrame(
            [fit],
            "n bigint, df_model int, df_residual bigint, r2 double, r2_adjusted double, f double, "
            "log_likelihood double, aic double, bic double",
        ),
    )


def pairwise_formula(target: str, variables: Sequence[str], *, max_terms: int = 500) -> str:
    """All main effects and all pairwise interactions. Too many terms for one dense solve
    raise an error rather than being cut."""
    terms = len(variables) + sum(1 for _ in combinations(variables, 2))
    if terms > max_terms:
        raise ValueError(f"{terms} terms exceed max_terms={max_terms}")
    return f"{target} ~ ({' + '.join(variables)})^2"
