"""Scalar functions, one test per null or formatting trap."""

import math
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campusgrid import functions as fn


def values(df):
    return [r[0] for r in df.collect()]


def test_zero_pad_code(spark):
    df = spark.createDataFrame([("19641",), ("019641",), ("19641.0",), ("1234567",), (None,), ("abc",), (" 7 ",)], "c string")
    assert values(df.select(fn.zero_pad_code("c"))) == ["019641", "019641", "019641", "1234567", None, None, "000007"]
    df = spark.createDataFrame([(15676.0,), (float("nan"),), (None,), (12345678.0,)], "c double")
    assert values(df.select(fn.zero_pad_code("c", 7))) == ["0015676", None, None, "12345678"]


def test_ordinal_map(spark):
    levels = {"En inicio": 1, "En proceso": 2, "Satisfactorio": 3}
    df = spark.createDataFrame([("EN INICIO",), ("en proceso",), (" Satisfactorio",), ("otro",), (None,)], "c string")
    assert values(df.select(fn.ordinal_map("c", levels))) == [1, 2, None, None, None]
    assert values(df.select(fn.ordinal_map("c", levels, ignore_case=False))) == [None] * 5


def test_flags(spark):
    df = spark.createDataFrame([("1",), ("2",), ("",), (None,)], "c string")
    assert values(df.select(fn.flag_equals("c"))) == [1, 0, 0, 0]
    assert values(df.select(fn.flag_present("c"))) == [1, 1, 1, 0]
    df = spark.createDataFrame([("SI",), ("NO",), ("si",), (None,)], "c string")
    assert values(df.select(fn.yes_no("c"))) == [1, 0, None, None]


def reduced(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().strip().upper()


def test_clean_text_examples(spark):
    samples = ["  Matemática\t", "Ñandú ½ ﬁn 東京 ß", "１２ℌello", "plain", "", "𝐀𝒃x", "a b…", "x́y"]
    df = spark.createDataFrame([(s,) for s in [*samples, None]], "s string")
    assert values(df.select(fn.clean_text("s"))) == [*map(reduced, samples), None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0")), min_size=1, max_size=20))
def test_clean_text_any(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    found = dict(df.select("i", fn.clean_text("s")).collect())
    assert [found[i] for i in range(len(texts))] == [reduced(s) for s in texts]


def test_row_sum_and_mean_skip_nulls(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (None, None)], "a int, b int")
    assert values(df.select(fn.row_sum(["a", "b"]))) == [3, 3, 0]
    assert values(df.select(fn.row_mean(["a", "b"]))) == [1.5, 3.0, None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(6, 3), (6, 0), (0, 0), (None, 2)], "a int, b int")
    assert values(df.select(fn.safe_ratio("a", "b"))) == [2.0, None, None, None]


def test_interactions(spark):
    df = spark.createDataFrame([("Urbana", 2), ("Rural", 3), (None, 4)], "area string, n int")
    assert values(df.select(fn.category_interaction("area", "Urbana", "n"))) == [2, 0, 0]
    assert values(df.select(fn.product_interaction("n", "n"))) == [4, 9, 16]
    assert values(df.select(fn.abs_error("n", F.lit(3)))) == [1, 0, 1]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, s string")
    clean = fn.nan_to_null(df)
    assert values(clean) == [1.0, None, None]
    assert df.where(fn.present(df, ["x", "s"])).count() == 1


def test_hash_bucket_is_even_and_stable(spark, spread):
    df = spread(spark.range(20_000))
    sizes = dict(df.groupBy(fn.hash_bucket("id", 10)).count().collect())
    assert set(sizes) == set(range(10)) and all(1800 < n < 2200 for n in sizes.values())
    assert spark.range(1).select(fn.hash_bucket(F.lit("7"), 100)).first()[0] == int("8f14e45f", 16) % 100


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2.0)], ["a.b `c`", "dist_km_utm_log+1"])
    assert df.select(fn.row_sum(["a.b `c`", "dist_km_utm_log+1"])).first()[0] == 3.0
    assert not math.isnan(df.select(fn.as_column("a.b `c`")).first()[0])
