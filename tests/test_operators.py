"""Table operators on small hand-made frames."""

import random

import pytest
from pyspark.sql import functions as F

from campusgrid.operators import aggregate as agg
from campusgrid.operators import columns as cols
from campusgrid.operators import relational as rel
from campusgrid.operators import reshape
from campusgrid.operators.factored import Joined, joined_means
from campusgrid.operators.quantiles import column_modes, exact_quantiles

from conftest import rows


def test_keep_first_follows_order(spark, spread):
    df = spread(spark.createDataFrame([("a", 3, "z"), ("a", 1, None), ("b", 2, "q"), (None, 5, "n"), (None, 4, "m")], "k string, o int, v string"))
    assert rows(rel.keep_first(df, "k", ["o"])) == [(None, 4, "m"), ("a", 1, None), ("b", 2, "q")]


def test_keep_first_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    out = rel.keep_first(df, "k", ["id"])
    assert out.count() == 20_001 - 0
    assert out.where("k = 0").first()["id"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    with pytest.raises(ValueError):
        rel.require_unique(df, "k")
    assert rel.require_unique(df.where("k is null"), "k").count() == 2


def test_left_join_names_and_nulls(spark, spread):
    left = spread(spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, v string"))
    right = spread(spark.createDataFrame([(1, "r", 10), (None, "n", 20)], "k int, v string, w int"))
    assert rows(rel.left_join(left, right, "k")) == [(None, "y", None, None), (1, "x", "r", 10), (3, "z", None, None)]
    assert rows(rel.left_join(left, right, "k", null_safe=True)) == [(None, "y", "n", 20), (1, "x", "r", 10), (3, "z", None, None)]
    both = rel.left_join(left, right.withColumnRenamed("k", "j"), [("k", "j")], suffix="_y")
    assert both.columns == ["k", "v", "j", "v_y", "w"]


def test_star_join_keeps_rows(spark, spread):
    base = spread(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, n int"))
    d1 = spark.createDataFrame([("a", 10), ("c", 30), (None, 1)], "k string, x int")
    d2 = spark.createDataFrame([("b", 20)], "k string, y int")
    assert rows(rel.star_join(base, [d1, d2], "k")) == [
        (None, 4, None, None), ("a", 1, 10, None), ("a", 2, 10, None), ("b", 3, None, 20),
    ]


def test_star_join_splits_hot_key(spark):
    """A key with most of the rows is split by adaptive execution in the single base join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        base = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
        dims = [
            spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")),
            spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("y")),
        ]
        out = rel.star_join(base, dims, "k")
        assert len(out.collect()) == 60_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_distinct_join_equals_join_then_distinct(spark, spread):
    a = spread(spark.createDataFrame([(1, "p"), (1, "p"), (2, "q")], "k int, a string"))
    b = spread(spark.createDataFrame([(1, "u"), (1, "u"), (1, "v")], "k int, b string"))
    plain = a.join(b, "k", "left").distinct()
    assert rows(rel.distinct_join(a, [(b, "k")])) == rows(plain)


def test_value_counts_and_top_k(spark, spread):
    df = spread(spark.createDataFrame([("b",), ("a",), ("a",), ("c",), ("c",), (None,)], "v string"))
    assert [tuple(r) for r in rel.value_counts(df, "v").collect()] == [("a", 2), ("c", 2), ("b", 1)]
    df = spread(spark.createDataFrame([("x", 1.0), ("y", 3.0), ("z", 3.0), ("w", None)], "n string, m double"))
    assert [r[0] for r in rel.top_k(df, "m", 2, ties=["n"]).collect()] == ["y", "z"]


def test_profile_and_flags(spark, spread):
    df = spread(spark.createDataFrame([("a", "1", "2"), ("a", None, "10"), (None, "1", "3"), ("b", "0", "x")], "k string, f string, p string"))
    out = agg.profile(df, "k", agg.row_count().alias("n"), agg.flag_sum("f").alias("f"), agg.number_max("p").alias("p"))
    assert rows(out) == [("a", 2, 1, 10), ("b", 1, 0, None)]


def test_value_count_null_only_without_any_value(spark, spread):
    df = spread(spark.createDataFrame([("a", "03"), ("b", None), ("c", "01"), ("c", None)], "k string, t string"))
    assert rows(agg.profile(df, "k", agg.value_count("t", "01").alias("n"))) == [("a", 0), ("b", None), ("c", 1)]


def test_first_value_skips_nulls(spark, spread):
    df = spread(spark.createDataFrame([("a", 1, None), ("a", 2, "r2"), ("a", 3, "r3"), ("b", 1, None)], "k string, o int, r string"))
    assert rows(agg.profile(df, "k", agg.first_value("r", "o").alias("r"))) == [("a", "r2"), ("b", None)]


def test_count_pivot(spark, spread):
    df = spread(spark.createDataFrame([("a", "11"), ("a", "11"), ("a", None), ("b", "12"), ("c", None), (None, "11"), ("b", "")], "k string, v string"))
    out = reshape.count_pivot(df, "k", "v", prefix="P")
    assert out.columns == ["k", "P", "P11", "P12"]
    assert rows(out) == [("a", 0, 2, 0), ("b", 1, 0, 1)]
    assert reshape.count_pivot(df, "k", "v", prefix="P", blank_as_null=True).columns == ["k", "P11", "P12"]
    assert rows(reshape.count_pivot(df, "k", "v", values=["12", "99"])) == [("a", 0, 0), ("b", 1, 0)]


def test_pivot_value_limit_is_an_error(spark):
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError):
            reshape.count_pivot(spark.range(10).selectExpr("1 k", "string(id) v"), "k", "v")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)


def test_mean_pivot_zero_and_null(spark, spread):
    data = [("a", "lec", 2), ("a", "lec", 3), ("a", "mat", None), ("b", "lec", 1), ("c", None, 3), ("d", "mat", None)]
    df = spread(spark.createDataFrame(data, "k string, s string, x int"))
    zero = reshape.mean_pivot(df, ["k"], "s", "x", ["lec", "mat"], absent_as_zero=True)
    assert rows(zero) == [("a", 2.5, None), ("b", 1.0, 0.0), ("d", 0.0, None)]
    null = reshape.mean_pivot(df, ["k"], "s", "x", ["lec", "mat"])
    assert rows(null) == [("a", 2.5, None), ("b", 1.0, None)]


def test_dummies(spark, spread):
    df = spread(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "i int, c string"))
    assert rows(reshape.dummies(df, ["c"])) == [(1, 0, 0), (2, 1, 0), (3, 0, 1), (4, 0, 0)]
    assert reshape.dummies(df, ["c"], drop_first=False).columns == ["i", "c_a", "c_b", "c_c"]


def test_column_operators(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert cols.drop_columns(df, ["a", "zz"]).columns == ["b", "c"]
    with pytest.raises(KeyError):
        cols.drop_columns(df, ["zz"], strict=True)
    with pytest.raises(KeyError):
        cols.rename_expected(df, {"zz": "y"})
    assert cols.rename_expected(df, {"a": "ñ x"}).columns == ["ñ x", "b", "c"]
    assert rows(cols.conform_columns(df, ["c", "new"])) == [(2.0, 0)]
    assert cols.prefix_columns(df, "p_", except_for=["a"]).columns == ["a", "p_b", "p_c"]
    assert cols.columns_by_type(df, exclude=["c"]) == (["a"], ["b"])


def test_summaries(spark, spread):
    df = spread(spark.createDataFrame([(1, "x", 2.0), (2, None, 4.0), (3, "x", None)], "a int, b string, c double"))
    assert rows(agg.nonnull_profile(df)) == [("a", "int", 3), ("b", "string", 2), ("c", "double", 2)]
    assert rows(agg.distinct_profile(df)) == [("b", 1)]
    assert rows(agg.table_shape(df)) == [(3, 3)]
    assert rows(agg.describe_numeric(df)) == [
        ("a", 3, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0), ("c", 2, 3.0, pytest.approx(2**0.5), 2.0, 2.5, 3.0, 3.5, 4.0),
    ]


@pytest.mark.parametrize(
    "data",
    [
        [1.0],
        [5.0, 5.0, 5.0, 5.0],
        [float(i * i) for i in range(1001)],
        [1e300, -1e300, 0.0, 1e-300, -1e-300, 3.0],
        [float("inf"), float("-inf"), 1.0, 2.0, 3.0, float("-inf")],
        [0.1] * 500 + [0.2] + [0.3] * 499,
        [1.0 + i * 2.220446049250313e-16 for i in range(50)],
        [10.0**e for e in range(-150, 150)],
    ],
    ids=["one", "same", "squares", "huge", "infinite", "lumps", "neighbours", "magnitudes"],
)
def test_exact_quantiles(spark, spread, data):
    df = spread(spark.createDataFrame([(v,) for v in [*data, None, float("nan")]], "x double"))
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = exact_quantiles(df, ["x"], qs)["x"]
    ordered = sorted(data)
    for q, value in zip(qs, found):
        at = q * (len(ordered) - 1)
        a, b = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        wanted = a if at == int(at) or a == b else a + (b - a) * (at - int(at))
        assert value == pytest.approx(wanted, rel=1e-12, nan_ok=True), q


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [2.0]}


def test_modes_smallest_on_tie(spark, spread):
    df = spread(spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "u string, v string"))
    assert column_modes(df, ["u", "v"]) == {"u": "a", "v": None}


def test_joined_means_equal_the_joined_rows(spark, spread):
    """A tree of many-to-many left joins with null keys, null measures, null groups and rows that meet nothing."""
    r = random.Random(7)
    some = lambda *values: r.choice([*values, None])
    base = spark.createDataFrame([(some("a", "b"), some(1, 2, 3, 4), some("x", "y"), some(1.0, 2.0)) for _ in range(30)], "g string, k int, j string, u double")
    mid = spark.createDataFrame([(some(1, 2, 5), some(10, 20), some("p", "q"), some(3, 4)) for _ in range(25)], "mk int, leaf int, h string, v int")
    leaf = spark.createDataFrame([(some(10, 30), some(0.5, 7.5)) for _ in range(12)], "lk int, w double")
    side = spark.createDataFrame([(some("x", "z"),) for _ in range(9)], "sj string")
    joined = base.join(mid, base.k == mid.mk, "left").join(leaf, F.col("leaf") == leaf.lk, "left").join(side, base.j == side.sj, "left")
    wanted = joined.groupBy("g", "h").agg(F.count("*").alias("rows"), F.avg("u").alias("u"), F.avg("v").alias("v"), F.avg("w").alias("w"))
    tree = Joined(spread(base), None, ["g"], ["u"], [Joined(spread(mid), ("k", "mk"), ["h"], ["v"], [Joined(leaf, ("leaf", "lk"), [], ["w"])]), Joined(side, ("j", "sj"))])
    digits = lambda df: rows(df.select("g", "h", "rows", *[F.round(c, 9).alias(c) for c in "uvw"]))
    assert digits(joined_means(tree)) == digits(wanted)
    with pytest.raises(ValueError, match="names"):
        joined_means(Joined(base, None, ["g"], [], [Joined(base, ("k", "k"), ["g"])]))
