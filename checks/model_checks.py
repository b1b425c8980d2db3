"""Scaling, imputing, clustering, projection, regression and report tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from campusgrid.functions import hash_bucket
from campusgrid.operators import clustering, fourier, inference, projection, regression, reports, selection
from campusgrid.operators.prepare import build_preprocessor, hash_split, impute_medians, impute_modes, zscore
from campusgrid.operators.relational import left_join
from campusgrid.plans import segments
from campusgrid.session import keep

from .inputs import rounded, settled, table

QUERIES = {}
ORACLE = {}


def check(name, sql=None):
    def add(make):
        QUERIES[name] = make
        if sql:
            ORACLE[name] = sql
        return make

    return add


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(spark, sf):
    """Line rows with a text key."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf, "lineitem").withColumn("line", key)


_LINE = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_TEST = f"(('0x' || substr(md5({_LINE}), 1, 8))::bigint % 10000 < 2000)"


@check(
    "zscore",
    """with t as (select c_custkey, nullif(c_nationkey, 3)::double as nation, c_acctbal from customer),
            k as (select * from t where nation is not null)
       select c_custkey, round((nation - avg(nation) over ()) / stddev_pop(nation) over (), 6) as nation,
              round((c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over (), 6) as balance from k""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"), "c_acctbal")
    scaled, _ = zscore(c, ["nation", "c_acctbal"])
    return scaled.select("c_custkey", rounded("nation").alias("nation"), rounded("c_acctbal").alias("balance"))


@check(
    "impute_median",
    """with t as (select l_orderkey, l_linenumber, l_partkey, case when l_tax <= 0.04 then l_extendedprice end as price from lineitem)
       select l_orderkey, l_linenumber, l_partkey, round(coalesce(price, (select quantile_cont(price, 0.5) from t)), 4) as price from t""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_tax") <= 0.04, F.col("l_extendedprice")).alias("price")
    )
    return impute_medians(li, ["price"]).withColumn("price", rounded("price", 4))


@check(
    "impute_mode",
    """with t as (select o_orderkey, nullif(o_orderpriority, '5-LOW') as p, nullif(o_orderstatus, 'F') as s from orders)
       select o_orderkey,
              coalesce(p, (select p from t where p is not null group by p order by count(*) desc, p limit 1)) as p,
              coalesce(s, (select s from t where s is not null group by s order by count(*) desc, s limit 1)) as s from t""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"), F.nullif("o_orderstatus", F.lit("F")).alias("s")
    )
    return impute_modes(o, ["p", "s"])


@check(
    "one_hot",
    "select o_orderkey, (o_orderstatus = 'F')::int as hot_f, (o_orderstatus = 'O')::int as hot_o from orders",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    fitted = build_preprocessor([], ["o_orderstatus"]).fit(o.where("o_orderstatus <> 'P'"))
    hot = vector_to_array("features")
    return fitted.transform(o).select("o_orderkey", hot[0].cast("int").alias("hot_f"), hot[1].cast("int").alias("hot_o"))


@check("preprocessor")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = lines(spark, sf)
    train, _ = hash_split(rows, "line")
    fitted = build_preprocessor(MEASURES, ["l_returnflag", "l_linestatus"]).fit(train)
    return fitted.transform(rows).select("line", vector_to_array("features").alias("features"))


@check(
    "preprocessor_steps",
    f"""with t as (select {_LINE} as line, {_TEST} as test, case when l_tax > 0.02 then l_quantity end as x,
                         nullif(l_returnflag, 'N') as f from lineitem),
            m as (select quantile_cont(x, 0.5) as middle from t where not test),
            o as (select f as mode from t where not test and f is not null group by f order by count(*) desc, f limit 1),
            s as (select avg(coalesce(x, middle)) as mean, stddev_pop(coalesce(x, middle)) as dev from t, m where not test)
       select line, round((coalesce(x, middle) - mean) / dev, 6) as x, (coalesce(f, mode) = 'A')::double as a,
              (coalesce(f, mode) = 'R')::double as r from t, m, o, s""",
)
def _(spark, sf):
    """Median, mode, z-score and one-hot, all learned from the training rows."""
    from pyspark.ml.functions import vector_to_array

    x, f = F.when(F.col("l_tax") > 0.02, F.col("l_quantity")).alias("x"), F.nullif("l_returnflag", F.lit("N")).alias("f")
    rows = lines(spark, sf).select("line", x, f)
    train, _ = hash_split(rows, "line")
    at = vector_to_array("features")
    out = build_preprocessor(["x"], ["f"]).fit(train).transform(rows)
    return out.select("line", rounded(at[0]).alias("x"), at[1].alias("a"), at[2].alias("r"))


_CENTERS = [(10.0, 20000.0), (40.0, 20000.0), (25.0, 80000.0)]
_GAPS = ", ".join(
    f"(l_quantity - {q}) * (l_quantity - {q}) + (l_extendedprice - {p}) * (l_extendedprice - {p}) as d{i}"
    for i, (q, p) in enumerate(_CENTERS)
)
_NEAREST = f"""(select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
    case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end as cluster from (select *, {_GAPS} from lineitem))"""


def _nearest(spark, sf):
    label = clustering.nearest_center(["l_quantity", "l_extendedprice"], _CENTERS)
    return table(spark, sf, "lineitem").withColumn("cluster", label)


@check("nearest_center", f"select l_orderkey, l_linenumber, l_partkey, cluster from {_NEAREST}")
def _(spark, sf):
    return _nearest(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "cluster")


@check(
    "cluster_profile",
    f"""select cluster, count(*) as size, round(avg(l_quantity), 6) as l_quantity, round(avg(l_extendedprice), 4) as l_extendedprice
        from {_NEAREST} group by 1""",
)
def _(spark, sf):
    out = clustering.cluster_profile(_nearest(spark, sf), ["l_quantity", "l_extendedprice"])
    return out.select("cluster", "size", rounded("l_quantity").alias("l_quantity"), rounded("l_extendedprice", 4).alias("l_extendedprice"))


@check(
    "label_join",
    f"""select l.l_orderkey, l.l_linenumber, l.l_partkey, n.cluster::varchar as cluster from lineitem l
        left join (select * from {_NEAREST} where cluster < 2) n using (l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)""",
)
def _(spark, sf):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    labels = _nearest(spark, sf).where("cluster < 2").select(*key, F.col("cluster").cast("string").alias("cluster"))
    joined = left_join(table(spark, sf, "lineitem").select(*key), labels, key)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "cluster")


@check(
    "kmeans_separated",
    """select (l_linenumber - 1)::int as cluster, count(*) as size, l_linenumber::double as center from lineitem group by 1, 3""",
)
def _(spark, sf):
    rows = lines(spark, sf).select("line", F.col("l_linenumber").cast("double").alias("number"))
    fit = clustering.fit_kmeans(rows, ["number"], 7, key="line")
    out = clustering.cluster_profile(clustering.assign_clusters(rows, fit), ["number"])
    return out.select("cluster", "size", rounded("number").alias("center"))


@check("kmeans_fit")
def _(spark, sf):
    scaled, _ = zscore(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    fit = clustering.fit_kmeans(scaled, ["c_acctbal", "c_nationkey"], 4, key="c_custkey")
    return clustering.assign_clusters(scaled, fit).select("c_custkey", "cluster")


_SPLITS = """with v as (select l_linenumber::double as x, count(*)::double as n from lineitem group by 1),
    m as (select i::int as mask from range(0, 64) r(i)),
    g as (select mask, bit_count(mask & ((1 << (x::int - 1)) - 1)) as part, sum(n * x * x) - sum(n * x) * sum(n * x) / sum(n) as inertia
          from m, v group by 1, 2)"""


@check(
    "elbow_steps",
    f"""{_SPLITS}
        select k, round(min(inertia), 4) as inertia from (select mask, (bit_count(mask) + 1)::int as k, sum(inertia) as inertia from g group by 1)
        where k >= 2 group by 1""",
)
def _(spark, sf):
    rows = lines(spark, sf).select("line", F.col("l_linenumber").cast("double").alias("number"))
    return clustering.elbow(rows, ["number"], key="line", k_max=7).withColumn("inertia", rounded("inertia", 4))


@check("elbow")
def _(spark, sf):
    scaled, _ = zscore(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    return clustering.elbow(scaled, ["c_acctbal", "c_nationkey"], key="c_custkey")


def _vector_columns(spark, sf):
    """One column for each component; all vectors must have as many."""
    e = table(spark, sf, "embeddings")
    least, width = e.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if least != width:
        raise ValueError(f"vectors of {least} to {width} components")
    return e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(width)])


@check("kmeans_vectors")
def _(spark, sf):
    e = _vector_columns(spark, sf)
    cols = [c for c in e.columns if c != "vec_id"]
    fit = clustering.fit_kmeans(e, cols, 10, key="vec_id")
    return clustering.assign_clusters(e, fit).select("vec_id", "cluster")


@check(
    "pca_two_columns",
    """with z as (select c_custkey, (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () as a,
                         (x - avg(x) over ()) / stddev_pop(x) over () as b
                  from (select *, c_acctbal / 1000 + c_nationkey as x from customer)),
            r as (select corr(a, b) as r from z)
       select c_custkey, round((a + b) / sqrt(2), 6) as pc1, round(50 * (1 + r), 6) as percent from z, r""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").withColumn("x", F.col("c_acctbal") / 1000 + F.col("c_nationkey"))
    scaled, _ = zscore(c.select("c_custkey", "c_acctbal", "x"), ["c_acctbal", "x"])
    fit = projection.fit_pca(scaled, ["c_acctbal", "x"])
    return projection.project(scaled, fit).select(
        "c_custkey", rounded("pc1").alias("pc1"), rounded(F.lit(100 * fit.explained[0])).alias("percent")
    )


# 120 columns of rank two: multiples of a balance, and multiples of a nation's number.
_U, _V = [0.1 * (i % 7 + 1) for i in range(60)], [0.05 * (i % 5 + 1) for i in range(60)]
_NORM = [sum(w * w for w in side) ** 0.5 for side in (_U, _V)]


@check(
    "pca_wide",
    f"""with t as (select c_custkey, {_NORM[0]!r} * (s - avg(s) over ()) as a, {_NORM[1]!r} * (t - avg(t) over ()) as b
                  from (select c_custkey, c_acctbal / 1000 as s, c_nationkey::double as t from customer)),
            m as (select avg(a * a) as aa, avg(a * b) as ab, avg(b * b) as bb from t),
            w as (select *, 0.5 * atan2(2 * ab, aa - bb) as w, sqrt((aa - bb) * (aa - bb) / 4 + ab * ab) as r from m)
       select c_custkey, round(a * cos(w) + b * sin(w), 5) as pc1, round(b * cos(w) - a * sin(w), 5) as pc2,
              round(100 * ((aa + bb) / 2 + r) / (aa + bb), 6) as percent from t, w""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey", "c_acctbal / 1000 as s", "double(c_nationkey) as t")
    made = {f"u{i}": F.col("s") * w for i, w in enumerate(_U)} | {f"v{i}": F.col("t") * w for i, w in enumerate(_V)}
    wide = c.select("c_custkey", *[column.alias(name) for name, column in made.items()])
    fit = projection.fit_pca(wide, list(made), block=16)
    points = projection.project(wide, fit)
    percent = rounded(F.lit(100 * fit.explained[0])).alias("percent")
    return points.select("c_custkey", *[rounded(f"pc{i}", 5).alias(f"pc{i}") for i in (1, 2)], percent)


@check("pca_points")
def _(spark, sf):
    e = _vector_columns(spark, sf)
    cols = [c for c in e.columns if c != "vec_id"]
    scaled = keep(zscore(e, cols)[0])
    fit = clustering.fit_kmeans(scaled, cols, 4, key="vec_id")
    points = reports.cluster_points(scaled, fit, projection.fit_pca(scaled, cols), key="vec_id")
    return settled(points, scaled.unpersist)


# Four separate groups of customers in two correlated measures.
_MEASURED = """select c_custkey, c_nationkey % 4 as g, 10.0 * ((c_nationkey % 4) // 2) + c_acctbal / 100000 as a,
    10.0 * (c_nationkey % 2) + 3.0 * ((c_nationkey % 4) // 2) + c_acctbal / 200000 as b from customer"""
# Clusters are numbered in order of their centres.
_GROUPS = f"""select *, (dense_rank() over (order by ma, mb) - 1)::int as cluster
    from (select *, avg(a) over (partition by g) as ma, avg(b) over (partition by g) as mb from ({_MEASURED}))"""


def _groups(spark, sf):
    half = F.floor(F.col("c_nationkey") % 4 / 2)
    return table(spark, sf, "customer").select(
        "c_custkey", (10 * half + F.col("c_acctbal") / 100000).alias("a"),
        (10 * (F.col("c_nationkey") % 2) + 3 * half + F.col("c_acctbal") / 200000).alias("b"),
    )


@check(
    "pca_points_planted",
    f"""with z as (select c_custkey, cluster, (a - avg(a) over ()) / stddev_pop(a) over () as a,
                         (b - avg(b) over ()) / stddev_pop(b) over () as b from ({_GROUPS}))
       select c_custkey, cluster, round((a + b) / sqrt(2), 5) as pc1, round(abs(a - b) / sqrt(2), 5) as pc2 from z""",
)
def _(spark, sf):
    scaled = keep(zscore(_groups(spark, sf), ["a", "b"])[0])
    fit = clustering.fit_kmeans(scaled, ["a", "b"], 4, key="c_custkey")
    points = reports.cluster_points(scaled, fit, projection.fit_pca(scaled, ["a", "b"]), key="c_custkey")
    points = points.select("c_custkey", "cluster", rounded("pc1", 5).alias("pc1"), rounded(F.abs("pc2"), 5).alias("pc2"))
    return settled(points, scaled.unpersist)


@check(
    "segments_planted",
    f"select cluster, count(*) as size, round(avg(a), 5) as a, round(avg(b), 5) as b from ({_GROUPS}) group by cluster",
)
def _(spark, sf):
    found = segments.segment(_groups(spark, sf), ["a", "b"], key="c_custkey", k_max=5)
    profile = found.profile.select("cluster", "size", rounded("a", 5).alias("a"), rounded("b", 5).alias("b"))
    return settled(profile, found.release)


@check("pca_variance")
def _(spark, sf):
    scaled, _ = zscore(table(spark, sf, "lineitem"), MEASURES)
    return reports.explained_variance(scaled, projection.fit_pca(scaled, MEASURES, components=4))


_LINEAR = "20000.0 + 1500.0 * l_quantity"


@check(
    "regression_metrics",
    f"""with t as (select l_extendedprice as y, {_LINEAR} as p from lineitem)
        select round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2, round(avg(abs(y - p)), 4) as mae, count(*) as n from t""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("p", F.expr("20000D + 1500D * l_quantity"))
    out = regression.regression_metrics(li, "l_extendedprice", "p")
    return out.select(rounded("r2").alias("r2"), rounded("mae", 4).alias("mae"), "n")


@check(
    "simple_regression",
    """select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
              round(regr_r2(l_extendedprice, l_quantity), 8) as r2 from lineitem""",
)
def _(spark, sf):
    out = regression.simple_regression(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return out.select(rounded("slope", 4).alias("slope"), rounded("intercept", 4).alias("intercept"), rounded("r2", 8).alias("r2"))


@check(
    "scored_report",
    f"""select {_LINE} as line, case when {_TEST} then 'test' else 'train' end as segment, l_extendedprice as actual,
               {_LINEAR} as prediction, round(abs(l_extendedprice - ({_LINEAR})), 4) as abs_error from lineitem""",
)
def _(spark, sf):
    scored = lines(spark, sf).withColumn("prediction", F.expr("20000D + 1500D * l_quantity"))
    train, test = hash_split(scored, "line")
    out = regression.scored_report([("train", train), ("test", test)], key="line", actual="l_extendedprice")
    return out.withColumn("abs_error", rounded("abs_error", 4))


# A target that depends on quantity, so that fits have something to find.
_TARGET = "(l_extendedprice / 100 + 40 * l_quantity)"
_FIT = f"""with t as (select l_quantity as x, {_TARGET} as y, {_TEST} as test from lineitem),
    f as (select regr_slope(y, x) as b, regr_intercept(y, x) as a, stddev_pop(x) as s from t where not test)"""


def _with_target(spark, sf):
    return lines(spark, sf).withColumn("y", F.expr("l_extendedprice / 100 + 40 * l_quantity"))


@check(
    "linear_fit",
    f"""{_FIT}
        select round(1 - sum((y - a - b * x) * (y - a - b * x)) / (var_pop(y) * count(*)), 6) as r2,
               round(avg(abs(y - a - b * x)), 4) as mae, count(*) as n from t, f where test""",
)
def _(spark, sf):
    run = regression.fit_regression(_with_target(spark, sf), "y", ["l_quantity"], [], key="line")
    return run.metrics.select(rounded("r2").alias("r2"), rounded("mae", 4).alias("mae"), "n")


@check("uplift", f"{_FIT} select round(a + 0 * b, 4) as mean_without, round(a + b, 4) as mean_with, round(b, 4) as uplift from f")
def _(spark, sf):
    run = regression.fit_regression(_with_target(spark, sf), "y", ["l_quantity"], [], key="line")
    out = regression.uplift(run.model, run.test, "l_quantity")
    return out.select(*[rounded(c, 4).alias(c) for c in out.columns])


@check("coefficient_table", f"{_FIT} select 'l_quantity' as feature, round(b * s, 4) as coefficient from f")
def _(spark, sf):
    run = regression.fit_regression(_with_target(spark, sf), "y", ["l_quantity"], [], key="line")
    return regression.coefficient_table(run).withColumn("coefficient", rounded("coefficient", 4))


@check(
    "prediction_report",
    f"""with t as (select {_LINE} as line, l_quantity as x, {_TARGET} as y, {_TEST} as test from lineitem),
             f as (select regr_slope(y, x) as b, regr_intercept(y, x) as a from t where not test)
        select line, case when test then 'test' else 'train' end as segment, round(a + b * x, 4) as prediction from t, f""",
)
def _(spark, sf):
    run = regression.fit_regression(_with_target(spark, sf), "y", ["l_quantity"], [], key="line")
    out = regression.run_report(run, key="line")
    return out.select("line", "segment", rounded("prediction", 4).alias("prediction"))


@check("regression_mixed")
def _(spark, sf):
    rows = _with_target(spark, sf)
    run = regression.fit_regression(rows, "y", ["l_quantity", "l_discount", "l_tax"], ["l_returnflag", "l_linestatus"], key="line")
    return regression.coefficient_table(run)


@check("regression_ridge")
def _(spark, sf):
    rows = _with_target(spark, sf)
    ridge = LinearRegression(regParam=0.1, elasticNetParam=0.0)
    return regression.fit_regression(rows, "y", ["l_quantity", "l_tax"], ["l_returnflag"], key="line", model=ridge).metrics


@check("gbt_fit")
def _(spark, sf):
    rows = _with_target(spark, sf)
    trees = GBTRegressor(seed=42)
    return regression.fit_regression(rows, "y", ["l_quantity", "l_tax"], ["l_returnflag"], key="line", model=trees).metrics


@check(
    "gbt_step",
    f"""with t as (select {_LINE} as line, l_linenumber > 3 as high, l_tax + 10 * (l_linenumber > 3)::int as y, {_TEST} as test from lineitem)
       select line, round(m, 6) as prediction from t join (select high, avg(y) as m from t where not test group by high) using (high)
       where test""",
)
def _(spark, sf):
    """One split explains the target, so the first tree's leaves are the means of its sides."""
    rows = lines(spark, sf).selectExpr("line", "double(l_linenumber) as number", "l_tax + 10 * int(l_linenumber > 3) as y")
    run = regression.fit_regression(rows, "y", ["number"], [], key="line", model=GBTRegressor(maxIter=1, maxDepth=1))
    return regression.predict(run.model, run.test).select("line", rounded("prediction").alias("prediction"))


@check(
    "ols_simple",
    f"""with t as (select l_quantity as x, {_TARGET} as y from lineitem),
             s as (select regr_slope(y, x) as b, regr_intercept(y, x) as a, regr_r2(y, x) as r2, count(*) as n, avg(x) as mx,
                          var_pop(x) * count(*) as sxx, var_pop(y) * count(*) as syy from t),
             e as (select *, sqrt((1 - r2) * syy / (n - 2)) as sd from s)
        select 'l_quantity' as term, round(b, 4) as coefficient, round(sd / sqrt(sxx), 6) as std_error, round(b / (sd / sqrt(sxx)), 4) as t from e
        union all
        select 'Intercept', round(a, 4), round(sd * sqrt(1.0 / n + mx * mx / sxx), 6), round(a / (sd * sqrt(1.0 / n + mx * mx / sxx)), 4) from e""",
)
def _(spark, sf):
    terms = inference.fit_ols(_with_target(spark, sf), "y ~ l_quantity", ["y", "l_quantity"]).terms
    return terms.select(
        "term", rounded("coefficient", 4).alias("coefficient"), rounded("std_error").alias("std_error"), rounded("t", 4).alias("t")
    )


@check(
    "ols_fit_statistics",
    f"""with t as (select l_quantity as x, {_TARGET} as y from lineitem),
             s as (select regr_r2(y, x) as r2, count(*) as n, var_pop(y) as vy from t),
             l as (select *, -n / 2.0 * (ln(2 * pi()) + ln((1 - r2) * vy) + 1) as ll from s)
        select n, round(r2, 6) as r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) as r2_adjusted,
               round(r2 / ((1 - r2) / (n - 2)), 2) as f, round(ll, 2) as log_likelihood, round(4 - 2 * ll, 2) as aic,
               round(2 * ln(n) - 2 * ll, 2) as bic from l""",
)
def _(spark, sf):
    fit = inference.fit_ols(_with_target(spark, sf), "y ~ l_quantity", ["y", "l_quantity"]).fit
    return fit.select(
        "n", rounded("r2").alias("r2"), rounded("r2_adjusted").alias("r2_adjusted"),
        *[rounded(c, 2).alias(c) for c in ("f", "log_likelihood", "aic", "bic")],
    )


@check("ols_interactions")
def _(spark, sf):
    rows = _with_target(spark, sf)
    used = ["y", "l_quantity", "l_tax", "l_discount", "l_returnflag"]
    return inference.fit_ols(rows, "y ~ l_quantity * l_tax + l_discount + l_returnflag", used).terms


@check("ols_pairwise")
def _(spark, sf):
    features = ["l_quantity", "l_tax", "l_discount"]
    return inference.fit_ols(_with_target(spark, sf), inference.pairwise_formula("y", features), ["y", *features]).terms


@check(
    "ols_collinear",
    """select term, coefficient from (values ('a', 1.1667::double), ('b', -0.3333::double), ('c', 0.8333::double), ('a:b', 0.25::double),
         ('a:c', 0.0::double), ('b:c', 0.0::double), ('Intercept', 7.0::double)) t(term, coefficient) where (select count(*) from lineitem) > 0""",
)
def _(spark, sf):
    """c = a + b: of all weights that fit, those of smallest norm."""
    rows = lines(spark, sf).selectExpr("l_quantity / 10 as a", "double(l_linenumber) as b").selectExpr("a", "b", "a + b as c", "7 + 2 * a + 0.5D * b + 0.25D * a * b as y")
    terms = inference.fit_ols(rows, inference.pairwise_formula("y", ["a", "b", "c"]), ["y", "a", "b", "c"]).terms
    return terms.select("term", (rounded("coefficient", 4) + 0.0).alias("coefficient"))


_WAVES, _PHASES = fourier.fourier_waves(2, 6, 0.5, 11)
_PLANTED = "2 + 0.5 * p + " + " + ".join(
    f"{w} * cos(p * {a!r} + q * {b!r} + {c!r})" for w, a, b, c in zip((1.5, -1, 0.25, 2, -0.5, 1), *_WAVES.tolist(), _PHASES.tolist())
)
_INPUTS = "select *, l_quantity / 50 as p, l_discount * 10 as q from lineitem"


@check("fourier_planted", f"select {_LINE} as line, round({_PLANTED}, 5) as y from ({_INPUTS})")
def _(spark, sf):
    """A target made of the very waves the regressor draws comes back without error."""
    rows = lines(spark, sf).selectExpr("line", "l_quantity / 50 as p", "l_discount * 10 as q")
    rows = VectorAssembler(inputCols=["p", "q"], outputCol="features").transform(rows.withColumn("label", F.expr(_PLANTED)))
    model = fourier.FourierRegressor(terms=6, width=0.5, ridge=0.0, seed=11).fit(rows)
    return model.transform(rows).select("line", rounded("prediction", 5).alias("y"))


@check("fourier_beats_linear", f"select true as curved, true as straight_fails, count(*) as n from (select *, {_TEST} as test from lineitem) where test")
def _(spark, sf):
    rows = lines(spark, sf).withColumn("y", F.expr("sin(l_quantity / 4) * cos(l_discount * 40) + l_tax"))
    linear, curved = (
        regression.fit_regression(rows, "y", ["l_quantity", "l_discount", "l_tax"], [], key="line", model=model).metrics
        for model in (None, fourier.FourierRegressor(terms=300, width=0.4))
    )
    both = curved.withColumn("curved", F.lit(True)).unionByName(linear.withColumn("curved", F.lit(False)))
    return both.selectExpr("r2 > 0.99 as high", "r2 < 0.2 as low", "n", "curved").groupBy("n").agg(
        F.bool_and(F.expr("not curved or high")).alias("curved"), F.bool_and(F.expr("curved or low")).alias("straight_fails")
    )


@check("lasso_select")
def _(spark, sf):
    return selection.lasso_cv(_with_target(spark, sf), ["l_quantity", "l_tax", "l_discount", "l_suppkey"], "y", key="line")


@check(
    "lasso_wide",
    """select feature, true as selected from (values ('customer_5'), ('customer_8'), ('price')) t(feature) where (select count(*) from orders) > 0""",
)
def _(spark, sf):
    """Two of all customers matter; every customer is a column."""
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "string(o_custkey) as customer", "o_totalprice / 1e5D as price")
    rows = rows.withColumn("y", F.expr("50 * int(customer = '5') - 50 * int(customer = '8') + 3 * price"))
    found = selection.lasso_cv(rows, ["customer", "price"], "y", key="o_orderkey", alphas=16, ratio=0.02, max_width=100)
    return found.where("abs(coefficient) > 0.3").select("feature", "selected")


@check(
    "progressive_models",
    f"""with t as (select l_quantity as x, l_tax as w, {_TARGET} as y from lineitem),
             c as (select corr(y, x) as yx, corr(y, w) as yw, corr(x, w) as xw, stddev_pop(y) / stddev_pop(x) as ratio from t)
        select 'one' as model, round(yx * yx, 6) as r2, round(yx * ratio, 4) as coefficient from c
        union all select 'two', round((yx * yx + yw * yw - 2 * yx * yw * xw) / (1 - xw * xw), 6),
                         round((yx - yw * xw) / (1 - xw * xw) * ratio, 4) from c""",
)
def _(spark, sf):
    out = selection.compare_nested(
        _with_target(spark, sf), [("one", ["l_quantity"]), ("two", ["l_quantity", "l_tax"])], "y", focus="l_quantity"
    )
    return out.select("model", rounded("r2").alias("r2"), rounded("coefficient", 4).alias("coefficient"))


@check("progressive_categories")
def _(spark, sf):
    steps = [("one", ["l_quantity"]), ("two", ["l_quantity", "l_returnflag"]), ("three", ["l_quantity", "l_returnflag", "l_tax"])]
    return selection.compare_nested(_with_target(spark, sf), steps, "y", focus="l_quantity")


@check(
    "moments",
    """select ('0x' || substr(md5(l_orderkey::varchar), 1, 8))::bigint % 5 as fold, count(*) as n,
              round(sum(l_quantity * l_tax), 4) as cross from lineitem group by 1""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("fold", hash_bucket("l_orderkey", 5))
    found = selection.moments(rows, ["l_quantity", "l_tax"], group="fold")
    out = [(g, int(m[0, 0]), round(float(m[1, 2]), 4)) for g, m in found.items()]
    return spark.createDataFrame(out, "fold bigint, n bigint, cross double")


@check(
    "hash_split_null_keys",
    """with t as (select o_orderkey, case when o_custkey % 3 > 0 then o_custkey::varchar end as key from orders)
       select o_orderkey, case when ('0x' || substr(md5(coalesce(key, '')), 1, 8))::bigint % 10000 < 2000 then 'test' else 'train' end as side
       from t""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "if(o_custkey % 3 > 0, string(o_custkey), null) key")
    train, test = hash_split(rows, "key")
    sides = [part.select("o_orderkey", F.lit(name).alias("side")) for name, part in (("train", train), ("test", test))]
    return sides[0].unionByName(sides[1])


# A target that is a function of oddly named columns and almost nothing else, so that the coefficients are known.
_ODD = """select c_custkey, case when c_custkey % 9 = 0 then null else c_custkey end as key, c_acctbal / 1000 as "dist_km_utm_log+1",
    c_nationkey::double as "QM DIRECTO", case when c_nationkey % 2 = 0 then 'Urbana' else 'Rural' end as "Área" from customer"""


def _odd(spark, sf, target):
    rows = spark.sql(_ODD.replace('"', "`").replace("::double", "").replace("from customer", "from {c}"), c=table(spark, sf, "customer"))
    return rows.withColumn("y", F.expr(target))


@check(
    "ols_odd_names",
    """select term, coefficient from (values ('dist_km_utm_log+1', 2.0::double), ('QM DIRECTO', 0.5::double), ('Área_Urbana', -3.0::double),
         ('dist_km_utm_log+1:QM DIRECTO', 0.25::double), ('Intercept', 7.0::double)) t(term, coefficient) where (select count(*) from customer) > 0""",
)
def _(spark, sf):
    rows = _odd(
        spark, sf,
        "7 + 2 * `dist_km_utm_log+1` + 0.5D * `QM DIRECTO` - 3 * int(`Área` = 'Urbana') + 0.25D * `dist_km_utm_log+1` * `QM DIRECTO`"
        " + 1e-4D * pmod(c_custkey * 7919, 13)",
    )
    names = ["dist_km_utm_log+1", "QM DIRECTO", "Área"]
    formula = f"{inference.pairwise_formula('y', names[:2])} + Área"
    terms = inference.fit_ols(rows, formula, ["y", *names]).terms
    return terms.select("term", (rounded("coefficient", 2) + 0.0).alias("coefficient"))


@check(
    "lasso_text_feature",
    """select feature, selected from (values ('Área_Urbana', true), ('QM DIRECTO', false)) t(feature, selected)
       where (select count(*) from customer) > 0""",
)
def _(spark, sf):
    rows = _odd(spark, sf, "5 - 3 * int(`Área` = 'Urbana')")
    return selection.lasso_cv(rows, ["Área", "QM DIRECTO"], "y", key="key").select("feature", "selected")


@check("histogram_with_nan", """select 0 as bin, count(*) as count from orders where o_custkey % 5 > 1 and o_totalprice < 1e12""")
def _(spark, sf):
    price = F.expr("case when o_custkey % 5 = 0 then double('NaN') when o_custkey % 5 > 1 then o_totalprice end")
    return reports.histogram(table(spark, sf, "orders").select(price.alias("p")), "p", bins=1).select("bin", "count")


_BINNED = """with t as (select min(c_acctbal) as lo, max(c_acctbal) as hi, count(*) as n,
                  quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25) as iqr from customer),
    b as (select *, {bins} as bins from t),
    e as (select i::int as bin, lo, hi, bins from b, range(0, 1000) r(i) where i < bins)
    select bin, round(lo + bin * ((hi - lo) / bins), 4) as low, round(lo + (bin + 1) * ((hi - lo) / bins), 4) as high,
           (select count(*) from customer where least(floor((c_acctbal - lo) / ((hi - lo) / bins)), bins - 1) = bin) as count from e"""


@check("histogram_bins", _BINNED.format(bins="20"))
def _(spark, sf):
    out = reports.histogram(table(spark, sf, "customer"), "c_acctbal", bins=20)
    return out.withColumns({"low": rounded("low", 4), "high": rounded("high", 4)})


@check(
    "histogram_auto",
    _BINNED.format(bins="ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), greatest(2 * iqr / pow(n, 1.0 / 3), (hi - lo) / sqrt(n) / 2)))::int"),
)
def _(spark, sf):
    out = reports.histogram(table(spark, sf, "customer"), "c_acctbal")
    return out.withColumns({"low": rounded("low", 4), "high": rounded("high", 4)})


@check(
    "kernel_density",
    """with t as (select min(c_acctbal) as lo, max(c_acctbal) as hi, count(*) as n,
                         stddev_samp(c_acctbal) * pow(count(*), -0.2) as h from customer),
            g as (select lo + i * ((hi - lo) / 199) as x, n, h from t, range(0, 200) r(i))
       select round(x, 4) as x, round(sum(exp(-0.5 * ((c_acctbal - x) / h) * ((c_acctbal - x) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) * 1000000, 4)
              as density from g, customer group by x""",
)
def _(spark, sf):
    out = reports.kernel_density(table(spark, sf, "customer"), "c_acctbal")
    return out.select(rounded("x", 4).alias("x"), rounded(F.col("density") * 1000000, 4).alias("density"))


@check(
    "series_by_group",
    """select o_custkey, o_orderpriority, sum(n)::bigint as n, round(sum(mean_price * n) / sum(n), 4) as mean_price from
         (select o_custkey, o_orderpriority, o_orderstatus, count(*) as n, avg(o_totalprice) as mean_price from orders group by 1, 2, 3)
       group by 1, 2""",
)
def _(spark, sf):
    base = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_price")
    )
    out = reports.series_by_group(base, "o_custkey", "o_orderpriority", size="n", mean="mean_price")
    return out.withColumn("mean_price", rounded("mean_price", 4))
