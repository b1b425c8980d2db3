"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid import functions as fn
from campusgrid.operators import columns as ops
from campusgrid.operators.aggregate import mean_of_difference

from .inputs import rounded, table

QUERIES = {}
ORACLE = {}


def check(name, sql=None):
    def add(make):
        QUERIES[name] = make
        if sql:
            ORACLE[name] = sql
        return make

    return add


@check("select_columns", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@check(
    "computed_column",
    "select o_orderkey, o_totalprice * 2 as doubled, cast(o_custkey as string) as customer_code from orders",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumns({"doubled": F.col("o_totalprice") * 2, "customer_code": F.col("o_custkey").cast("string")}).select(
        "o_orderkey", "doubled", "customer_code"
    )


@check(
    "rename_columns",
    'select c_custkey as "COD_MOD", c_name as nombre, c_mktsegment as "forma de atención" from customer',
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ops.rename_expected(c, {"c_custkey": "COD_MOD", "c_name": "nombre", "c_mktsegment": "forma de atención"})


@check("prefix_columns", 'select s_suppkey, s_name as "prov_s_name", s_acctbal as "prov_s_acctbal" from supplier')
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return ops.prefix_columns(s, "prov_", except_for=["s_suppkey"])


@check("drop_lenient", "select p_partkey, p_name, p_brand, p_type, p_size from part")
def _(spark, sf):
    return ops.drop_columns(table(spark, sf, "part"), ["p_retailprice", "not_there"])


@check("drop_strict", "select p_partkey, p_name, p_brand, p_type from part")
def _(spark, sf):
    return ops.drop_columns(table(spark, sf, "part"), ["p_retailprice", "p_size"], strict=True)


@check("conform_columns", 'select s_suppkey, s_name, cast(0 as bigint) as "P61_409" from supplier')
def _(spark, sf):
    return ops.conform_columns(table(spark, sf, "supplier"), ["s_suppkey", "s_name", "P61_409"])


@check(
    "columns_by_type",
    """select 'number' as kind, sum(n) as cells from (
         select count(l_orderkey) + count(l_partkey) + count(l_suppkey) + count(l_linenumber) + count(l_quantity)
              + count(l_extendedprice) + count(l_discount) + count(l_tax) as n from lineitem)
       union all
       select 'text', count(l_returnflag) + count(l_linestatus) from lineitem""".replace("sum(n)", "cast(sum(n) as bigint)"),
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    numbers, texts = ops.columns_by_type(li)
    totals = [
        F.struct(F.lit(kind).alias("kind"), sum((F.count(c) for c in cols[1:]), F.count(cols[0])).alias("cells"))
        for kind, cols in (("number", numbers), ("text", texts))
    ]
    return li.agg(F.array(*totals).alias("t")).select(F.inline("t"))


@check("set_constant", "select o_orderkey, 1 as treated, 'A' as scenario from orders")
def _(spark, sf):
    return table(spark, sf, "orders").withColumns({"treated": F.lit(1), "scenario": F.lit("A")}).select(
        "o_orderkey", "treated", "scenario"
    )


@check("segment_tag", "select c_custkey, 'Prueba' as segment from customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.lit("Prueba").alias("segment"))


@check("filter_equal", "select * from orders where o_orderstatus = 'F'")
def _(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")


@check(
    "filter_group_size",
    "select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 5",
)
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 5")


@check(
    "filter_not_null",
    """select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment from customer
       where nullif(c_mktsegment, 'BUILDING') is not null""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return c.dropna(subset=["segment"]).select("c_custkey", "segment")


@check(
    "filter_any_null",
    """select * from (select l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'R') as flag,
                             nullif(l_linestatus, 'O') as status from lineitem)
       where flag is not null and status is not null""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_returnflag", F.lit("R")).alias("flag"),
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
    )
    return li.dropna(how="any", subset=["flag", "status"])


@check(
    "zero_pad_code",
    """select c_custkey,
              case when length(c_custkey::varchar) < 6 then lpad(c_custkey::varchar, 6, '0') else c_custkey::varchar end as site,
              case when c_nationkey = 0 then null else lpad(c_custkey::varchar, 7, '0') end as module,
              (c_custkey + 12345678)::varchar as uncut
       from customer""",
)
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.zero_pad_code("c_custkey").alias("site"),
        fn.zero_pad_code(F.when(F.col("c_nationkey") != 0, F.col("c_custkey").cast("double")), 7).alias("module"),
        fn.zero_pad_code((F.col("c_custkey") + 12345678).cast("double")).alias("uncut"),
    )


@check("lower_text", "select p_partkey, lower(p_brand) as brand from part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lower("p_brand").alias("brand"))


@check(
    "ordinal_map",
    """select o_orderkey,
              case lower(o_orderpriority) when '1-urgent' then 1 when '2-high' then 2 when '3-medium' then 3 end as level,
              case o_orderpriority when '1-URGENT' then 1 when '5-LOW' then 5 end as exact_level
       from orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fn.ordinal_map("o_orderpriority", {"1-Urgent": 1, "2-High": 2, "3-Medium": 3}).alias("level"),
        fn.ordinal_map("o_orderpriority", {"1-URGENT": 1, "2-high": 2, "5-LOW": 5}, ignore_case=False).alias("exact_level"),
    )


@check(
    "flag_equals",
    """select o_orderkey, coalesce((nullif(o_orderstatus, 'O') = 'F')::int, 0) as is_f,
              (substr(o_orderpriority, 1, 1) = '1')::int as is_first from orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fn.flag_equals(F.nullif("o_orderstatus", F.lit("O")), "F").alias("is_f"),
        fn.flag_equals(F.substring("o_orderpriority", 1, 1)).alias("is_first"),
    )


@check(
    "flag_present",
    "select o_orderkey, (nullif(o_orderstatus, 'O') is not null)::int as has_status from orders",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.flag_present(F.nullif("o_orderstatus", F.lit("O"))).alias("has_status")
    )


@check(
    "clean_text",
    r"""select doc_id, upper(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'),
                                            '^\s+|\s+$', '', 'g')) as cleaned from documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fn.clean_text("text").alias("cleaned"))


@check(
    "yes_no_map",
    "select c_custkey, case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 0 end as flag from customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", fn.yes_no("c_mktsegment", yes="BUILDING", no="MACHINERY").alias("flag")
    )


def _sparse_lines(spark, sf):
    """Line rows with nulls made in two measures."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif("l_discount", F.lit(0.0)).alias("a"),
        F.nullif("l_tax", F.lit(0.0)).alias("b"),
    )


_SPARSE = """(select l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.0) as a, nullif(l_tax, 0.0) as b from lineitem)"""


@check(
    "row_sum",
    f"select l_orderkey, l_linenumber, l_partkey, round(coalesce(a, 0) + coalesce(b, 0), 6) as total from {_SPARSE}",
)
def _(spark, sf):
    return _sparse_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", rounded(fn.row_sum(["a", "b"])).alias("total"))


@check(
    "row_mean",
    f"""select l_orderkey, l_linenumber, l_partkey,
               round((coalesce(a, 0) + coalesce(b, 0)) / nullif((a is not null)::int + (b is not null)::int, 0), 6) as mean
        from {_SPARSE}""",
)
def _(spark, sf):
    return _sparse_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", rounded(fn.row_mean(["a", "b"])).alias("mean"))


@check(
    "safe_ratio",
    "select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(l_tax, 0), 4) as ratio from lineitem",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", rounded(fn.safe_ratio("l_extendedprice", "l_tax"), 4).alias("ratio")
    )


@check(
    "abs_error",
    "select l_orderkey, l_linenumber, l_partkey, round(abs(l_discount - l_tax), 6) as error from lineitem",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", rounded(fn.abs_error("l_discount", "l_tax")).alias("error")
    )


@check(
    "interaction_features",
    """select l_orderkey, l_linenumber, l_partkey, coalesce((nullif(l_returnflag, 'N') = 'A')::int, 0) * l_quantity as flag_x_quantity,
              round(l_quantity * l_discount, 6) as quantity_x_discount from lineitem""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fn.category_interaction(F.nullif("l_returnflag", F.lit("N")), "A", "l_quantity").alias("flag_x_quantity"),
        rounded(fn.product_interaction("l_quantity", "l_discount")).alias("quantity_x_discount"),
    )


@check("cast_text", "select c_custkey, c_nationkey::varchar as nation from customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))


@check("mean_difference", "select round(avg(l_discount - l_tax), 6) as mean_difference from lineitem")
def _(spark, sf):
    return mean_of_difference(table(spark, sf, "lineitem"), "l_discount", "l_tax").select(
        rounded("mean_difference").alias("mean_difference")
    )


@check(
    "hash_split",
    """select c_custkey, case when ('0x' || substr(md5(c_custkey::varchar), 1, 8))::bigint % 10000 < 2000
                         then 'test' else 'train' end as part from customer""",
)
def _(spark, sf):
    from campusgrid.operators.prepare import hash_split

    train, test = hash_split(table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
