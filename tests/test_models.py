"""Fitted steps: exact values where they are known, invariants elsewhere."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from campusgrid.operators import boosting, clustering, inference, projection, regression, reports, selection, sketches
from campusgrid.operators.fourier import FourierRegressor, fourier_waves
from campusgrid.operators.least_squares import triangular_factor, two_sided_p
from campusgrid.operators.prepare import BinnerModel, MedianImputer, build_preprocessor, hash_split, impute_modes, zscore

from campusgrid.operators.wide_lasso import wide_lasso_cv

from conftest import rows


@pytest.fixture(scope="module")
def noisy(spark):
    """y = 2 + 3a - b + 5[c = 'q'] without noise; d is unrelated."""
    rng = np.random.default_rng(1)
    data = []
    for i in range(400):
        a, b, d = (float(v) for v in rng.normal(size=3))
        c = "pqr"[i % 3]
        data.append((i, a, b, c, d, 2 + 3 * a - b + (5.0 if c == "q" else 0.0)))
    return spark.createDataFrame(data, "id int, a double, b double, c string, d double, y double").cache()


def test_zscore_uses_population_deviation(spark, spread):
    df = spread(spark.createDataFrame([("p", 1.0, 5.0), ("q", 3.0, 5.0), ("r", None, 5.0), ("s", float("nan"), 5.0)], "k string, x double, c double"))
    out, _ = zscore(df, ["x", "c"])
    assert rows(out) == [("p", -1.0, 0.0), ("q", 1.0, 0.0)]


def test_imputers_fill_and_save(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (10.0, None), (None, "b")], "x double, s string")
    model = MedianImputer(inputCols=["x"]).fit(df)
    assert [r.x for r in model.transform(df).collect()] == [1.0, 2.0, 10.0, 2.0]
    assert [r.s for r in impute_modes(df, ["s"]).collect()] == ["b", "a", "b", "b"]
    chain = build_preprocessor(["x"], ["s"]).fit(df)
    chain.write().overwrite().save(str(tmp_path / "chain"))
    loaded = PipelineModel.load(str(tmp_path / "chain"))
    assert rows(loaded.transform(df).select("features")) == rows(chain.transform(df).select("features"))


def test_one_hot_unknown_gives_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "s string")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    out = build_preprocessor([], ["s"]).fit(train).transform(new).select(vector_to_array("features"))
    assert [r[0] for r in out.collect()] == [[1.0, 0.0], [0.0, 0.0], [0.0, 1.0]]


def test_hash_split_is_a_partition(spark, spread):
    df = spread(spark.range(5000))
    train, test = hash_split(df, "id")
    assert train.count() + test.count() == 5000 and 900 < test.count() < 1100
    assert not {r.id for r in train.collect()} & {r.id for r in test.collect()}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centers = [(0, 0), (8, 0), (0, 8), (8, 8)]
    data = [
        (f"k{c}-{i}", float(x + rng.normal(0, 0.3)), float(y + rng.normal(0, 0.3)))
        for c, (x, y) in enumerate(centers)
        for i in range(60 + 20 * c)
    ]
    return spark.createDataFrame(data, "k string, x double, y double").cache()


def test_kmeans_finds_blobs(spark, blobs, spread):
    fit = clustering.fit_kmeans(spread(blobs), ["x", "y"], 4, key="k")
    labels = clustering.assign_clusters(blobs, fit)
    groups = {}
    for r in labels.collect():
        groups.setdefault(r.k.split("-")[0], set()).add(r.cluster)
    assert all(len(v) == 1 for v in groups.values()) and len({min(v) for v in groups.values()}) == 4
    assert list(fit.centers) == sorted(fit.centers)
    cost = labels.agg(
        F.sum(
            F.expr("case cluster " + " ".join(f"when {i} then pow(x-({c[0]}),2)+pow(y-({c[1]}),2)" for i, c in enumerate(fit.centers)) + " end")
        )
    ).first()[0]
    assert cost == pytest.approx(fit.inertia, rel=1e-9)


def test_kmeans_same_on_any_partitioning(spark, blobs):
    fits = [clustering.fit_kmeans(blobs.repartition(n), ["x", "y"], 3, key="k") for n in (1, 5, 16)]
    for other in fits[1:]:
        assert np.allclose(fits[0].centers, other.centers, atol=1e-9)


def test_elbow_does_not_rise(spark, blobs):
    table = clustering.elbow(blobs, ["x", "y"], key="k", k_max=6).orderBy("k").collect()
    costs = [r.inertia for r in table]
    assert [r.k for r in table] == [2, 3, 4, 5, 6]
    assert all(a >= b for a, b in zip(costs, costs[1:]))


def test_kmeans_finds_three_far_rows_among_many(spark):
    far = F.expr("if(id in (7, 123456, 399999), 1e4, if(id % 2 = 0, 0D, 10D) + pmod(xxhash64(id), 1000) / 1000D)")
    rows = spark.range(400_000).select("id", far.alias("x"))
    fit = clustering.fit_kmeans(rows, ["x"], 3, key="id")
    assert [round(c[0]) for c in fit.centers] in ([0, 10, 10_000], [1, 11, 10_000], [0, 11, 10_000], [1, 10, 10_000])
    assert fit.inertia < 400_000 / 12 * 1.05


def test_swap_costs_are_exact(spark):
    """What a pass says a swap costs is what the swapped centres cost."""
    rng = np.random.default_rng(8)
    x, weight = rng.normal(size=(300, 3)), rng.integers(1, 5, 300).astype(float)
    centers, tried = x[:4], x[10:15]
    cost = lambda c: float((weight * ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1)).sum())
    sums = clustering._swap_sums(x, weight, centers, tried)
    assert sums[0, 0] == pytest.approx(cost(centers))
    for i, row in enumerate(tried):
        assert sums[i + 1, 0] == pytest.approx(cost(np.vstack([centers, row])))
        for j in range(4):
            swapped = centers.copy()
            swapped[j] = row
            assert sums[i + 1, 0] + sums[i + 1, j + 1] == pytest.approx(cost(swapped))


def test_kmeans_leaves_a_poor_optimum_by_swaps(spark):
    """One start only, on blobs of very different sizes: nearly every draw puts two centres into a large blob."""
    rng = np.random.default_rng(2)
    places = [(20.0 * i, 20.0 * (i % 3)) for i in range(9)]
    data = [(n, float(x + rng.normal()), float(y + rng.normal())) for n, (i, (x, y)) in enumerate((i, p) for i, p in enumerate(places) for _ in range(20 if i % 2 else 600))]
    df = spark.createDataFrame(data, "k int, x double, y double")
    for seed in range(3):
        fit = clustering.fit_kmeans(df, ["x", "y"], 9, key="k", starts=1, seed=seed)
        found = sorted((round(a / 20), round(b / 20)) for a, b in fit.centers)
        assert found == sorted((i, i % 3) for i in range(9))


def test_kmeans_reads_the_rows_a_bounded_number_of_times(spark, monkeypatch):
    passes = []
    for name in ("far", "sums", "swaps"):
        plain = getattr(clustering._Points, name)
        monkeypatch.setattr(clustering._Points, name, lambda *a, _plain=plain, _name=name: (passes.append(_name), _plain(*a))[1])
    df = spark.range(3000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000).alias(f"x{i}") for i in range(4)])
    clustering.elbow(df, [f"x{i}" for i in range(4)], key="id", k_max=10)
    assert passes.count("far") == 2 and passes.count("sums") + passes.count("swaps") < 40


def test_kmeans_more_clusters_than_points(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    fit = clustering.fit_kmeans(df, ["x"], 4, key="k")
    assert fit.inertia == pytest.approx(0.0)


def test_pca_matches_numpy(spark, spread):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) @ np.array([[2, 0.3, 0], [0, 1, 0.5], [0, 0, 0.2]])
    df = spread(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double"))
    scaled, _ = zscore(df, ["a", "b", "c"])
    fit = projection.fit_pca(scaled, ["a", "b", "c"])
    z = (x - x.mean(0)) / x.std(0)
    share = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    assert fit.explained == pytest.approx(share[:2] / share.sum())
    w = np.array(fit.loadings)
    assert np.allclose(w @ w.T, np.eye(2), atol=1e-9)
    points = projection.project(scaled, fit).orderBy("i").select("pc1", "pc2").toPandas().to_numpy()
    assert np.allclose(points, z @ w.T, atol=1e-9)


@pytest.mark.parametrize("rank, noise", [(3, 0.0), (90, 0.02)])
def test_pca_of_many_columns_by_a_random_block(spark, rank, noise):
    """More columns than the block: the same components as the whole covariance has."""
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(400, rank)) * 0.7 ** np.arange(rank)) @ rng.normal(size=(rank, 90)) + noise * rng.normal(size=(400, 90)) + 5
    cols = [f"c{i}" for i in range(90)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], cols).repartition(3)
    fit = projection.fit_pca(df, cols, components=3, block=16)
    values, turn = np.linalg.eigh(np.cov(x.T))
    assert fit.explained == pytest.approx((values[::-1][:3] / values.sum()).tolist(), rel=1e-8)
    assert np.abs(np.abs(np.sum(np.array(fit.loadings).T * turn[:, ::-1][:, :3], axis=0)) - 1).max() < 1e-8
    with pytest.raises(ValueError):
        projection.fit_pca(df.where("false"), cols)


def test_regression_recovers_known_model(spark, noisy):
    run = regression.fit_regression(noisy, "y", ["a", "b"], ["c"], key="id")
    found = run.metrics.first()
    assert found.r2 == pytest.approx(1.0) and found.mae == pytest.approx(0.0, abs=1e-6)
    coefs = dict(tuple(r) for r in regression.coefficient_table(run).collect())
    assert set(coefs) == {"a", "b", "c_p", "c_q", "c_r"}
    assert coefs["c_q"] - coefs["c_p"] == pytest.approx(5.0, abs=1e-6)
    assert regression.uplift(run.model, run.test, "a").first().uplift == pytest.approx(3.0, abs=1e-6)
    report = regression.run_report(run, key="id")
    assert report.count() == 400 and {r.segment for r in report.collect()} == {"train", "test"}
    assert report.agg(F.max("abs_error")).first()[0] < 1e-5


def test_regression_with_missing_and_empty_columns(spark, noisy):
    holes = noisy.withColumns(
        {"a": F.when(F.col("id") % 7 > 0, F.col("a")), "void": F.lit(None).cast("double"), "none": F.lit(None).cast("string")}
    )
    run = regression.fit_regression(holes, "y", ["a", "b", "void"], ["c", "none"], key="id")
    assert 0.5 < run.metrics.first().r2 < 1.0
    assert run.train.where("y is null").count() == 0


def test_metrics_of_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert tuple(regression.regression_metrics(df, "y", "p").first()) == (1.0, 0.0, 2)
    assert regression.regression_metrics(df.withColumn("p", F.lit(2.0)), "y", "p").first().r2 == 0.0


def test_ols_matches_numpy(spark, noisy):
    rng = np.random.default_rng(9)
    shaken = noisy.toPandas()
    shaken["y"] += rng.normal(0, 0.5, len(shaken))
    df = spark.createDataFrame(shaken)
    result = inference.fit_ols(df, "y ~ a * b + c", ["y", "a", "b", "c"])
    x = np.column_stack(
        [shaken.a, shaken.b, shaken.a * shaken.b, shaken.c == "q", shaken.c == "r", np.ones(len(shaken))]
    ).astype(float)
    beta, *_ = np.linalg.lstsq(x, shaken.y, rcond=None)
    resid = shaken.y - x @ beta
    s2 = resid @ resid / (len(x) - 6)
    errors = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * s2)
    terms = {r.term: r for r in result.terms.collect()}
    for name, b, e in zip(["a", "b", "a:b", "c_q", "c_r", "Intercept"], beta, errors):
        assert terms[name].coefficient == pytest.approx(b, rel=1e-6)
        assert terms[name].std_error == pytest.approx(e, rel=1e-6)
    fit = result.fit.first()
    n = len(x)
    loglik = -n / 2 * (math.log(2 * math.pi) + math.log(resid @ resid / n) + 1)
    assert fit.log_likelihood == pytest.approx(loglik) and fit.aic == pytest.approx(12 - 2 * loglik)
    assert fit.df_model == 5 and fit.df_residual == n - 6


def test_ols_collinear_terms_get_the_smallest_norm(spark, noisy, spread):
    """The pseudo-inverse's answer, whatever the units of the columns."""
    df = spread(noisy.withColumn("a2", F.col("a") * 1e-6).withColumn("one", F.lit(3.0)).withColumn("y", F.col("y") + F.col("d")))
    result = inference.fit_ols(df, "y ~ a + a2 + b + one", ["y", "a", "a2", "b", "one"])
    rows = df.toPandas()
    x = np.column_stack([rows.a, rows.a2, rows.b, rows.one, np.ones(len(rows))]).astype(float)
    wanted = np.linalg.pinv(x, rcond=1e-12) @ rows.y.to_numpy()
    terms = {r.term: r for r in result.terms.collect()}
    assert [terms[t].coefficient for t in ("a", "a2", "b", "one", "Intercept")] == pytest.approx(list(wanted), rel=1e-6)
    resid = rows.y - x @ wanted
    inverse = np.linalg.pinv(x, rcond=1e-12)
    errors = np.sqrt(np.diag(inverse @ inverse.T) * (resid @ resid) / (len(x) - 3))
    fit = result.fit.first()
    assert (fit.df_model, fit.df_residual) == (2, len(x) - 3)
    assert terms["b"].std_error == pytest.approx(errors[2], rel=1e-6)


def test_factors_keep_digits_that_cross_products_lose(spark):
    """x and x + 1e-6 z: the cross products cannot tell them apart, the factor can."""
    data = [(i, float(i % 17), float(i % 17) + 1e-6 * (i % 5)) for i in range(500)]
    df = spark.createDataFrame(data, "i int, x double, w double").withColumn("y", 2 * F.col("x") + 1e5 * (F.col("w") - F.col("x")))
    found = {r.term: r.coefficient for r in inference.fit_ols(df.repartition(7), "y ~ x + w", ["y", "x", "w"]).terms.collect()}
    assert found["w"] == pytest.approx(1e5, rel=1e-6) and found["x"] == pytest.approx(2 - 1e5, rel=1e-6)


@pytest.mark.parametrize("parts", [1, 3, 70])
def test_factor_tree(spark, parts):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 4))
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "x array<double>").repartition(parts)
    factor = triangular_factor(df, "x", 4)
    assert np.allclose(factor.T @ factor, x.T @ x) and np.allclose(factor, np.triu(factor))
    assert not triangular_factor(df.where("false"), "x", 4).any()


def test_fourier_regressor_on_a_smooth_function(spark, tmp_path):
    """Far better than a plane, the same on any partitioning, and saved like any other stage."""
    rows = spark.range(4000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_000)) / 2500 - 2).alias(c) for i, c in enumerate("ab")])
    rows = rows.withColumn("y", F.sin(2 * F.col("a")) * F.cos("b") + F.col("a") * F.col("b") / 4)
    plain = regression.fit_regression(rows, "y", ["a", "b"], [], key="id")
    smooth = regression.fit_regression(rows, "y", ["a", "b"], [], key="id", model=FourierRegressor(terms=200))
    assert plain.metrics.first().r2 < 0.3 and smooth.metrics.first().r2 > 0.999
    again = regression.fit_regression(rows.repartition(13), "y", ["a", "b"], [], key="id", model=FourierRegressor(terms=200))
    assert again.metrics.first().r2 == pytest.approx(smooth.metrics.first().r2, abs=1e-9)
    smooth.model.write().overwrite().save(str(tmp_path / "smooth"))
    loaded = PipelineModel.load(str(tmp_path / "smooth"))
    some = rows.limit(20)
    assert [r.prediction for r in loaded.transform(some).collect()] == [r.prediction for r in smooth.model.transform(some).collect()]
    assert smooth.model.transform(rows.where("false")).count() == 0


def _bumpy(spark, n):
    """Numbers that hardly repeat, one with few values, some unknown, and a category."""
    unit = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1_000_003)) / 1_000_003 for i in range(4)]
    df = spark.range(n).select(
        "id",
        F.when(unit[3] > 0.02, unit[0] * 10).alias("a"),
        F.floor(unit[1] * 5).cast("double").alias("b"),
        F.when(unit[3] < 0.97, F.substring(F.lit("pqr"), (F.floor(unit[2] * 3) + 1).cast("int"), 1)).alias("c"),
    )
    noise = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1000)) / 1000
    return df.withColumn("y", F.sin(F.coalesce("a", F.lit(5.0))) * F.col("b") + F.when(F.col("c") == "q", 2.0).otherwise(0.0) + noise)


def test_boosted_trees_learn_from_cells(spark, monkeypatch, tmp_path):
    """The learner reads at most a row for each combination of bins, whatever the partitioning and however many values."""
    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df, *more: (seen.append(df.count()), fit(self, df, *more))[1])
    trees = GBTRegressor(seed=42, maxIter=4, maxDepth=4)
    runs = [regression.fit_regression(_bumpy(spark, 25_000).repartition(p), "y", ["a", "b"], ["c"], key="id", model=trees) for p in (3, 13)]
    first, again = (r.metrics.first() for r in runs)
    assert first.r2 == pytest.approx(again.r2, abs=0.005) and first.r2 > 0.8
    assert runs[0].train.select("a").distinct().count() > 10_000
    assert all(100 < n <= 32 * 5 * 3 for n in seen)
    runs[0].model.write().overwrite().save(str(tmp_path / "trees"))
    loaded, some = PipelineModel.load(str(tmp_path / "trees")), runs[0].test.limit(50)
    assert [r.prediction for r in loaded.transform(some).collect()] == [r.prediction for r in runs[0].model.transform(some).collect()]


def test_boosted_trees_on_cells_equal_those_on_rows(spark):
    """Up to 10 000 rows the learner takes its bins from all rows, so both ways must find the same trees."""
    rows = _bumpy(spark, 9_000).withColumn("a", F.round("a", 2))
    run = regression.fit_regression(rows, "y", ["a", "b"], ["c"], key="id", model=GBTRegressor(seed=42))
    chain = build_preprocessor(["a", "b"], ["c"]).fit(run.train)
    plain = GBTRegressor(seed=42, labelCol="y").fit(chain.transform(run.train))
    assert len(run.model.stages) == len(chain.stages) + 3
    both = plain.transform(chain.transform(run.test)).select("id", F.col("prediction").alias("plain"))
    pairs = regression.predict(run.model, run.test).join(both, "id").select("prediction", "plain").collect()
    assert len(pairs) > 1500 and max(abs(p.prediction - p.plain) for p in pairs) < 1e-9


def test_boosted_trees_do_not_depend_on_partitioning(spark):
    """Values of few digits: counted, not drawn, also beyond the 10 000 rows of the learner's own draw."""
    rows = _bumpy(spark, 25_000).withColumn("a", F.round("a", 2))
    trees = GBTRegressor(seed=42, maxIter=4)
    found = [regression.fit_regression(rows.repartition(p), "y", ["a", "b"], ["c"], key="id", model=trees).metrics.first() for p in (3, 13)]
    assert tuple(found[0]) == pytest.approx(tuple(found[1]), abs=1e-9)


def test_boosted_trees_on_rows_where_cells_are_many(spark):
    run = regression.fit_regression(_bumpy(spark, 600), "y", ["a", "b"], ["c"], key="id", model=GBTRegressor(maxIter=2))
    assert run.model.stages[-1].getFeaturesCol() == "features"
    assert not boosting.merges_rows(GBTRegressor(lossType="absolute")) and not boosting.merges_rows(GBTRegressor(minInstancesPerNode=2))


def test_bin_edges(spark):
    """Few values are all kept apart, however rare; many are cut into equal shares of all rows."""
    df = spark.range(40_000).select((F.col("id") % 4 + 3 * (F.col("id") == 7).cast("int")).cast("double").alias("x"), (F.col("id") / 8).alias("z"))
    few, many = boosting.bin_edges(df, ["x", "z"], [5, 40_000], 32)
    assert few == [0.5, 1.5, 2.5, 4.5]
    assert many == pytest.approx([5000 * k / 32 for k in range(1, 32)], abs=2)
    assert boosting.even_edges([1.0, 2.0, 3.0, 4.0], [5, 1, 1, 3], 2) == [1.5]


def test_binner_counts_edges_below(spark):
    df = spark.createDataFrame([(-9.0,), (1.0,), (1.5,), (2.0,), (3.0,), (9.0,), (None,), (math.nan,)], "x double").repartition(1)
    found = BinnerModel()._set(inputCols=["x"], outputCols=["n"], edges=[[1.0, 2.0, 3.0]]).transform(df)
    got = {r.x: r.n for r in found.where("x is not null and not isnan(x)").collect()}
    assert got == {-9.0: 0, 1.0: 0, 1.5: 1, 2.0: 1, 3.0: 2, 9.0: 3}
    assert found.where("x is null and n is null or isnan(x) and isnan(n)").count() == 2


def test_fourier_ridge_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(300, 2)), rng.normal(size=300)
    df = spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "label"]).repartition(5)
    model = FourierRegressor(terms=30, ridge=0.01, seed=3).fit(df)
    waves, phases = fourier_waves(2, 30, 1.0, 3)
    z = np.column_stack([np.ones(300), x, np.cos(x @ waves + phases)])
    penalty = np.diag([0.0] + [0.01 * 300] * 32)
    assert model.getOrDefault(model.weights) == pytest.approx(list(np.linalg.solve(z.T @ z + penalty, z.T @ y)), rel=1e-6, abs=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        FourierRegressor().fit(df.where("false"))


def test_student_p_values():
    # Two-sided odds from tables.
    for t, freedom, p in ((12.706, 1, 0.05), (2.571, 5, 0.05), (2.042, 30, 0.05), (2.750, 30, 0.01), (1.960, 10**7, 0.05), (0.0, 9, 1.0)):
        assert two_sided_p(t, freedom) == pytest.approx(p, rel=1e-3)
    assert two_sided_p(40.0, 100) < 1e-60 and two_sided_p(-2.571, 5) == two_sided_p(2.571, 5)


def test_wide_lasso_equals_lasso_on_few_columns(spark, noisy):
    rng = np.random.default_rng(12)
    shaken = noisy.toPandas()
    shaken["y"] += rng.normal(0, 2.0, len(shaken))
    shaken.loc[::17, "a"] = None
    df = spark.createDataFrame(shaken).withColumn("same", F.lit(1.0)).repartition(5)
    features = ["a", "b", "d", "c", "same"]
    few = {r.feature: r for r in selection.lasso_cv(df, features, "y", key="id", tol=1e-9).collect()}
    wide = {r.feature: r for r in wide_lasso_cv(df, features, "y", key="id").collect()}
    assert set(few) == set(wide)
    for name, r in few.items():
        assert wide[name].alpha == pytest.approx(r.alpha) and wide[name].coefficient == pytest.approx(r.coefficient, abs=1e-6)


def test_wide_lasso_finds_few_values_among_thousands(spark):
    place = F.pmod(F.xxhash64("id"), F.lit(4000))
    effect = F.when(place == 7, 30.0).when(place == 3999, -30.0).otherwise(0.0)
    rows = spark.range(24_000).select("id", F.concat(F.lit("v"), place).alias("place"), (F.col("id") % 10 / 10).alias("x"), effect.alias("e"))
    rows = rows.withColumn("y", F.col("e") + 2 * F.col("x") + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 1000)
    found = wide_lasso_cv(rows, ["x", "place"], "y", key="id", alphas=12, ratio=0.05)
    assert found.count() > 3900
    assert {r.feature for r in found.where("abs(coefficient) > 0.05").collect()} == {"x", "place_v7", "place_v3999"}
    with pytest.raises(ValueError, match="max_active"):
        wide_lasso_cv(rows, ["x", "place"], "y", key="id", alphas=12, ratio=1e-4, max_active=5)


def test_wide_lasso_of_texts_that_go_together(spark):
    """Values of different texts that stand in the same rows share what they explain, as in ``lasso_cv``."""
    rng = np.random.default_rng(5)
    n = 1500
    place = rng.integers(0, 12, n)
    kind = np.where(rng.random(n) < 0.6, place // 3, rng.integers(0, 5, n))
    size = rng.normal(0, 1, n) + place / 6
    y = 3 * (place == 2) - 2 * (kind == 1) + 1.5 * (kind == 3) + 0.8 * size + rng.normal(0, 0.5, n)
    rows = pd.DataFrame({"id": np.arange(n), "place": [f"p{v:02d}" for v in place], "kind": [f"k{v}" for v in kind], "size": size, "y": y + 40})
    rows.loc[::11, "kind"] = None
    df, features = spark.createDataFrame(rows).repartition(5), ["kind", "size", "place"]
    few = {r.feature: r for r in selection.lasso_cv(df, features, "y", key="id", alphas=30, tol=1e-10).collect()}
    wide = {r.feature: r for r in wide_lasso_cv(df, features, "y", key="id", alphas=30, tol=1e-10).collect()}
    assert set(few) == set(wide) and sum(r.selected for r in wide.values()) > 5
    for name, r in few.items():
        assert wide[name].alpha == pytest.approx(r.alpha) and wide[name].coefficient == pytest.approx(r.coefficient, abs=1e-6)


def test_wide_lasso_keeps_categories_off_the_driver(spark, monkeypatch):
    """Neither what the driver gets nor what it sends to tasks grows with the number of categories."""
    got, sent = [], []
    frame = type(spark.range(1))
    for name in ("collect", "toArrow", "toPandas"):
        def counted(self, *args, was=getattr(frame, name), **named):
            found = was(self, *args, **named)
            got.append(len(found))
            return found

        monkeypatch.setattr(frame, name, counted)

    def measured(self, func, *args, was=frame.mapInArrow, **named):
        sent.append(len(cloudpickle.dumps(func)))
        return was(self, func, *args, **named)

    monkeypatch.setattr(frame, "mapInArrow", measured)
    rows = spark.range(20_000).selectExpr("id", "concat('v', id % 4000) place", "id % 10 / 10 x", "30 * int(id % 4000 = 7) + 2 * (id % 10 / 10) y")
    found = wide_lasso_cv(rows, ["x", "place"], "y", key="id", alphas=6, ratio=0.2, max_active=60)
    assert max(got) <= 1000 and max(sent) <= 100_000
    monkeypatch.undo()
    assert found.count() == 4000 and {r.feature for r in found.where("selected").collect()} == {"x", "place_v7"}


def test_wide_lasso_without_rows(spark, noisy):
    assert wide_lasso_cv(noisy.where("false"), ["a", "c"], "y", key="id").count() == 0


def test_pairwise_formula_limit():
    assert inference.pairwise_formula("y", ["a", "b"]) == "y ~ (a + b)^2"
    with pytest.raises(ValueError):
        inference.pairwise_formula("y", [f"v{i}" for i in range(60)])


def test_moments(spark, noisy, spread):
    m = selection.moments(spread(noisy), ["a", "b"])[0]
    x = noisy.select("a", "b").toPandas().to_numpy()
    full = np.column_stack([np.ones(len(x)), x])
    assert np.allclose(m, full.T @ full)


def test_lasso_drops_noise(spark, noisy):
    out = {r.feature: r for r in selection.lasso_cv(noisy, ["a", "b", "d"], "y", key="id").collect()}
    assert out["a"].selected and out["b"].selected and out["a"].coefficient > 2.5
    assert abs(out["d"].coefficient) < 0.15


def test_nested_models(spark, noisy):
    steps = [("M1", ["a"]), ("M2", ["a", "b"]), ("M3", ["a", "b", "c"]), ("M4", ["b"])]
    table = {r.model: r for r in selection.compare_nested(noisy, steps, "y", focus="a").collect()}
    assert table["M1"].r2 < table["M2"].r2 < table["M3"].r2 == pytest.approx(1.0)
    assert table["M3"].coefficient == pytest.approx(3.0) and table["M4"].coefficient == 0.0


def test_histogram_counts_everything(spark, spread):
    df = spread(spark.createDataFrame([(float(v),) for v in [0, 1, 1, 2, 10]] + [(None,)], "x double"))
    out = reports.histogram(df, "x", bins=5).orderBy("bin").collect()
    assert [r["count"] for r in out] == [3, 1, 0, 0, 1]
    wanted = np.histogram(np.array([0.0, 1, 1, 2, 10]), bins="auto")[0]
    assert [r["count"] for r in reports.histogram(df, "x").orderBy("bin").collect()] == list(wanted)


def test_density_matches_numpy(spark, blobs):
    out = reports.kernel_density(blobs, "x").orderBy("x").toPandas()
    x = blobs.select("x").toPandas().x.to_numpy()
    grid = np.linspace(x.min(), x.max(), 200)
    width = x.std(ddof=1) * len(x) ** -0.2
    wanted = np.exp(-0.5 * ((x[:, None] - grid) / width) ** 2).mean(axis=0) / (width * math.sqrt(2 * math.pi))
    assert np.allclose(out.x, grid) and np.allclose(out.density, wanted, rtol=0, atol=1e-10 * wanted.max())


def test_density_with_rows_far_away_and_bounded_work(spark):
    """The bins depend on the bandwidth, not on the rows; far rows and repeated ones are as exact as others."""
    x = np.concatenate([np.random.default_rng(1).standard_cauchy(3000), np.full(500, 0.25), [1e9]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    out = reports.kernel_density(df, "x", points=50).orderBy("x").toPandas()
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    wanted = np.exp(-0.5 * ((x[:, None] - grid) / width) ** 2).mean(axis=0) / (width * math.sqrt(2 * math.pi))
    assert np.allclose(out.density, wanted, rtol=0, atol=1e-10 * wanted.max())


def test_sketches_of_groups_merge(spark, spread):
    rows = spread(spark.range(40_000).selectExpr("id % 4 as a", "id % 3 as b", "if(id % 10 = 0, null, id % 9001) as v", "string(id % 5) as t"))
    fine = sketches.distinct_sketches(rows, ["a", "b"], ["v", "t"])
    assert fine.count() == 12
    for keys in (["a"], ["b"], []):
        exact = rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_distinct("v").alias("v"), F.count_distinct("t").alias("t")).collect()
        found = sketches.estimates(sketches.merge_sketches(fine, keys, ["v", "t"]), ["v", "t"]).collect()
        wanted = {tuple(r[k] for k in keys): r for r in exact}
        for r in found:
            own = wanted[tuple(r[k] for k in keys)]
            assert r["rows"] == own["rows"] and r["t"] == own["t"]
            assert abs(r["v"] / own["v"] - 1) < sketches.relative_error(14)
