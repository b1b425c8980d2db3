"""Joins, aggregates, pivots, dedup, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid.operators import aggregate as agg
from campusgrid.operators import relational as rel
from campusgrid.operators import reshape, sketches
from campusgrid.operators.columns import rename_expected

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


@check(
    "left_join_one_key",
    """select c_custkey, c_name, n, total from customer left join
         (select o_custkey as c_custkey, count(*) as n, round(sum(o_totalprice), 2) as total from orders
          where o_orderpriority = '1-URGENT' and o_totalprice > 300000 group by 1) using (c_custkey)""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 300000")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total")
    )
    return rel.left_join(table(spark, sf, "customer").select("c_custkey", "c_name"), per, "c_custkey")


@check(
    "left_join_two_names",
    """select s.s_suppkey, s.s_nationkey, n.n_nationkey, n.n_name from supplier s
       left join (select * from nation where n_regionkey <> 2) n on s.s_nationkey = n.n_nationkey""",
)
def _(spark, sf):
    n = table(spark, sf, "nation").where("n_regionkey <> 2").select("n_nationkey", "n_name")
    return rel.left_join(
        table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), n, [("s_nationkey", "n_nationkey")]
    )


@check(
    "left_join_null_safe",
    """select c.c_custkey, c.segment, d.n from (select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment from customer) c
       left join (select nullif(c_mktsegment, 'BUILDING') as segment, count(*) as n from customer group by 1) d
       on c.segment is not distinct from d.segment""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return rel.left_join(c, c.groupBy("segment").agg(F.count(F.lit(1)).alias("n")), "segment", null_safe=True)


@check(
    "fanout_distinct",
    """select distinct o.o_orderkey, o.o_orderstatus, a.l_returnflag, b.l_linestatus, b.l_linenumber
       from orders o left join (select l_orderkey, l_returnflag from lineitem) a on o.o_orderkey = a.l_orderkey
       left join (select l_orderkey, l_linestatus, l_linenumber from lineitem) b on o.o_orderkey = b.l_orderkey""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return rel.distinct_join(
        o,
        [
            (li.select("o_orderkey", "l_returnflag"), "o_orderkey"),
            (li.select("o_orderkey", "l_linestatus", "l_linenumber"), "o_orderkey"),
        ],
    )


@check(
    "star_join",
    """select l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, o.n_orders, p.n_lines, s.avg_tax
       from lineitem l
       left join (select o_orderkey as l_orderkey, count(*) as n_orders from orders where o_orderstatus = 'F' group by 1) o
         on l.l_orderkey = o.l_orderkey
       left join (select l_orderkey, count(*) as n_lines from lineitem group by 1) p on l.l_orderkey = p.l_orderkey
       left join (select l_orderkey, round(avg(l_tax), 6) as avg_tax from lineitem where l_quantity > 25 group by 1) s
         on l.l_orderkey = s.l_orderkey""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    dims = [
        o.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.count(F.lit(1)).alias("n_orders")),
        li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines")),
        li.where("l_quantity > 25").groupBy("l_orderkey").agg(rounded(F.avg("l_tax")).alias("avg_tax")),
    ]
    base = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return rel.star_join(base, dims, "l_orderkey", check=True)


@check(
    "customer_star",
    """select c_custkey, c_name, n_name, r_name, n_orders, max_price from customer
       left join (select o_custkey, count(*) as n_orders, max(o_totalprice) as max_price from orders group by 1) on c_custkey = o_custkey
       left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price")
    )
    out = rel.left_join(table(spark, sf, "customer"), o, [("c_custkey", "o_custkey")])
    out = rel.left_join(out, table(spark, sf, "nation"), [("c_nationkey", "n_nationkey")])
    out = rel.left_join(out, table(spark, sf, "region"), [("n_regionkey", "r_regionkey")])
    return out.select("c_custkey", "c_name", "n_name", "r_name", "n_orders", "max_price")


@check("group_size", "select o_custkey, count(*) as n from orders group by 1")
def _(spark, sf):
    return agg.profile(table(spark, sf, "orders"), "o_custkey", agg.row_count().alias("n"))


@check(
    "group_max_number",
    "select o_custkey, max(try_cast(substr(o_orderpriority, 1, 1) || (o_orderkey % 3)::varchar as int)) as top from orders group by 1",
)
def _(spark, sf):
    code = F.concat(F.substring("o_orderpriority", 1, 1), (F.col("o_orderkey") % 3).cast("string"))
    return agg.profile(table(spark, sf, "orders"), "o_custkey", agg.number_max(code).alias("top"))


@check(
    "group_flag_sums",
    """select l_suppkey, sum((l_returnflag = 'A')::int)::bigint as a, sum((l_linestatus = 'F')::int)::bigint as f
       from lineitem group by 1""",
)
def _(spark, sf):
    return agg.profile(
        table(spark, sf, "lineitem"),
        "l_suppkey",
        agg.flag_sum("l_returnflag", "A").alias("a"),
        agg.flag_sum("l_linestatus", "F").alias("f"),
    )


@check(
    "group_mean_multi_key",
    """select l_suppkey, l_returnflag, round(avg(l_extendedprice), 4) as mean_price from
         (select *, nullif(l_returnflag, 'N') as flag from lineitem) where flag is not null group by 1, 2""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return agg.profile(li, ["l_suppkey", "l_returnflag"], rounded(F.avg("l_extendedprice"), 4).alias("mean_price"))


@check(
    "multi_agg",
    """select o_custkey, o_orderstatus, count(nullif(o_orderpriority, '5-LOW')) as n,
              round(avg(o_totalprice), 5) as mean_price, round(avg(o_orderkey), 4) as mean_key,
              arg_min(nullif(o_orderpriority, '5-LOW'), (o_orderdate, o_orderkey))
                filter (where nullif(o_orderpriority, '5-LOW') is not null) as first_priority
       from orders group by 1, 2""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("p", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return agg.profile(
        o,
        ["o_custkey", "o_orderstatus"],
        F.count("p").alias("n"),
        rounded(F.avg("o_totalprice"), 5).alias("mean_price"),
        rounded(F.avg("o_orderkey"), 4).alias("mean_key"),
        agg.first_value("p", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"),
    )


@check(
    "distinct_multi_agg",
    """select l_suppkey, l_returnflag, l_linestatus, l_linenumber, count(distinct l_partkey) as parts,
              round(avg(l_quantity), 6) as q, round(avg(l_discount), 6) as d from lineitem group by 1, 2, 3, 4""",
)
def _(spark, sf):
    return agg.profile(
        table(spark, sf, "lineitem"),
        ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"],
        F.count_distinct("l_partkey").alias("parts"),
        rounded(F.avg("l_quantity")).alias("q"),
        rounded(F.avg("l_discount")).alias("d"),
    )


@check(
    "value_counts",
    """select segment, count(*) as count from (select nullif(c_mktsegment, 'BUILDING') as segment from customer)
       where segment is not null group by 1""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return rel.value_counts(c, "segment")


@check(
    "frequency_order",
    "select o_custkey, count(*) as count from orders group by o_custkey order by 2 desc, 1",
)
def _(spark, sf):
    return rel.value_counts(table(spark, sf, "orders"), "o_custkey")


@check(
    "describe_with_nan",
    """select 'price' as "column", count(price) as count, round(avg(price), 4) as mean, round(stddev_samp(price), 4) as std,
              min(price) as min, round(quantile_cont(price, 0.25), 4) as q25, round(quantile_cont(price, 0.5), 4) as q50,
              round(quantile_cont(price, 0.75), 4) as q75, max(price) as max
       from (select case when o_custkey % 5 > 1 then o_totalprice end as price from orders)""",
)
def _(spark, sf):
    price = F.expr("case when o_custkey % 5 = 0 then double('NaN') when o_custkey % 5 > 1 then o_totalprice end")
    out = agg.describe_numeric(table(spark, sf, "orders").select(price.alias("price")))
    return out.withColumns({c: rounded(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@check(
    "group_means_with_nan",
    """select o_orderstatus, count(*) as size, round(avg(case when o_custkey % 5 > 1 then o_totalprice end), 4) as price
       from orders group by 1""",
)
def _(spark, sf):
    price = F.expr("case when o_custkey % 5 = 0 then double('NaN') when o_custkey % 5 > 1 then o_totalprice end")
    rows = table(spark, sf, "orders").select("o_orderstatus", price.alias("price"))
    return agg.group_means(rows, "o_orderstatus", ["price"]).withColumn("price", rounded("price", 4))


@check(
    "describe_numeric",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
            min({c})::double as min, round(quantile_cont({c}::double, 0.25), 4) as q25, round(quantile_cont({c}::double, 0.5), 4) as q50,
            round(quantile_cont({c}::double, 0.75), 4) as q75, max({c})::double as max from lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def _(spark, sf):
    out = agg.describe_numeric(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select(
        "column", "count", *[rounded(c, 4).alias(c) for c in ("mean", "std")], "min",
        *[rounded(c, 4).alias(c) for c in ("q25", "q50", "q75")], "max",
    )


@check(
    "nonnull_profile",
    """select 'c_custkey' as "column", 'bigint' as type, count(c_custkey) as non_null from customer
       union all select 'segment', 'string', count(nullif(c_mktsegment, 'BUILDING')) from customer
       union all select 'c_acctbal', 'double', count(c_acctbal) from customer""",
)
def _(spark, sf):
    c = table(spark, sf, "customer")
    return agg.nonnull_profile(c.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal"))


@check("table_shape", "select count(*) as rows, 11 as columns from lineitem")
def _(spark, sf):
    return agg.table_shape(table(spark, sf, "lineitem"))


@check(
    "distinct_profile",
    """select 'l_returnflag' as "column", count(distinct nullif(l_returnflag, 'N')) as distinct_values from lineitem
       union all select 'l_partkey', count(distinct l_partkey) from lineitem""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return agg.distinct_profile(li, ["l_returnflag", "l_partkey"])


@check(
    "distinct_sketches",
    """select o_orderstatus, count(*) as rows, count(distinct o_custkey) as customers, true as close from orders group by 1""",
)
def _(spark, sf):
    """Sketches of status and month, written, read again and merged by status."""
    orders = table(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    fine = sketches.distinct_sketches(orders, ["o_orderstatus", "month"], ["o_custkey"])
    stored = settled(fine, lambda: None)
    merged = sketches.estimates(sketches.merge_sketches(stored, ["o_orderstatus"], ["o_custkey"]), ["o_custkey"])
    exact = agg.profile(orders, ["o_orderstatus"], F.count_distinct("o_custkey").alias("customers"))
    near = F.abs(F.col("o_custkey") / F.col("customers") - 1) <= sketches.relative_error(14)
    return rel.left_join(merged, exact, ["o_orderstatus"]).select("o_orderstatus", "rows", "customers", near.alias("close"))


@check(
    "median_fill_values",
    "select round(quantile_cont(l_extendedprice, 0.5), 4) as price, round(quantile_cont(l_quantity, 0.5), 4) as quantity from lineitem",
)
def _(spark, sf):
    from campusgrid.operators.quantiles import exact_quantiles

    li = table(spark, sf, "lineitem")
    found = exact_quantiles(li, ["l_extendedprice", "l_quantity"], [0.5])
    row = (round(found["l_extendedprice"][0], 4), round(found["l_quantity"][0], 4))
    return spark.createDataFrame([row], "price double, quantity double")


@check(
    "count_pivot_listed",
    """select o_custkey, count(*) filter (where o_orderstatus = 'F') as "st_F", count(*) filter (where o_orderstatus = 'X') as "st_X"
       from (select o_custkey, nullif(o_orderstatus, 'O') as o_orderstatus from orders) where o_orderstatus is not null group by 1""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    return reshape.count_pivot(o, "o_custkey", "o_orderstatus", values=["F", "X"], prefix="st_")


@check(
    "count_pivot_open",
    """select l_orderkey, count(*) filter (where f = 'A') as "rf_A", count(*) filter (where f = 'R') as "rf_R"
       from (select l_orderkey, nullif(l_returnflag, 'N') as f from lineitem) where f is not null group by 1""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("f", F.nullif("l_returnflag", F.lit("N")))
    return reshape.count_pivot(li, "l_orderkey", "f", prefix="rf_")


@check(
    "count_pivot_blank",
    """select l_orderkey, count(*) filter (where f = '') as "rf_", count(*) filter (where f = 'A') as "rf_A",
              count(*) filter (where f = 'R') as "rf_R"
       from (select l_orderkey, case when l_returnflag = 'N' then '' else l_returnflag end as f from lineitem) group by 1""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("f", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")))
    return reshape.count_pivot(li, "l_orderkey", "f", prefix="rf_")


_LEVELLED = """(select o_custkey, nullif(o_orderstatus, 'O') as subject,
                case when o_orderpriority in ('1-URGENT', '2-HIGH') then null else o_totalprice end as score from orders)"""


def _levelled(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("O")).alias("subject"),
        F.when(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_totalprice")).alias("score"),
    )


@check(
    "mean_pivot_zero",
    f"""select o_custkey,
               case when count(*) filter (where subject = 'F') = 0 then 0.0 else round(avg(score) filter (where subject = 'F'), 4) end as mean_f,
               case when count(*) filter (where subject = 'P') = 0 then 0.0 else round(avg(score) filter (where subject = 'P'), 4) end as mean_p
        from {_LEVELLED} where subject is not null group by 1""",
)
def _(spark, sf):
    out = reshape.mean_pivot(
        _levelled(spark, sf), ["o_custkey"], "subject", "score", ["F", "P"], absent_as_zero=True, prefix="v_"
    )
    named = rename_expected(out, {"v_F": "mean_f", "v_P": "mean_p"})
    return named.select("o_custkey", rounded("mean_f", 4).alias("mean_f"), rounded("mean_p", 4).alias("mean_p"))


@check(
    "mean_pivot_null",
    f"""select * from (select o_custkey, round(avg(score) filter (where subject = 'F'), 4) as "F",
                              round(avg(score) filter (where subject = 'P'), 4) as "P" from {_LEVELLED} group by 1)
        where "F" is not null or "P" is not null""",
)
def _(spark, sf):
    out = reshape.mean_pivot(_levelled(spark, sf), ["o_custkey"], "subject", "score", ["F", "P"])
    return out.select("o_custkey", rounded("F", 4).alias("F"), rounded("P", 4).alias("P"))


@check(
    "dummies",
    """select c_custkey, coalesce((s = 'BUILDING')::int, 0) as "s_BUILDING", coalesce((s = 'FURNITURE')::int, 0) as "s_FURNITURE",
              coalesce((s = 'HOUSEHOLD')::int, 0) as "s_HOUSEHOLD" from (select c_custkey, nullif(c_mktsegment, 'MACHINERY') as s from customer)""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("s"))
    return reshape.dummies(c, ["s"])


@check(
    "keep_first",
    """select * exclude (rn) from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn
       from orders) where rn = 1""",
)
def _(spark, sf):
    return rel.keep_first(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@check(
    "keep_first_null_key",
    """select segment, c_custkey from (select *, row_number() over (partition by segment order by c_custkey) as rn
       from (select nullif(c_mktsegment, 'BUILDING') as segment, c_custkey from customer)) where rn = 1""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_custkey")
    return rel.keep_first(c, "segment", ["c_custkey"])


@check("distinct_rows", "select distinct l_returnflag, l_linestatus, l_linenumber, l_suppkey from lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@check("distinct_values", "select distinct o_custkey from orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_custkey").distinct()


@check("first_rows", "select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 10")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").limit(10)


@check(
    "top_k",
    """select o_custkey, n, round(mean_price, 4) as mean_price from
         (select o_custkey, count(*) as n, avg(case when o_orderstatus = 'F' then o_totalprice end) as mean_price from orders group by 1)
       where n > 5 and mean_price is not null order by mean_price desc, o_custkey limit 15""",
)
def _(spark, sf):
    from campusgrid.operators.reports import top_groups

    groups = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("mean_price")
    )
    best = top_groups(groups, "mean_price", size="n", ties=["o_custkey"])
    return best.withColumn("mean_price", rounded("mean_price", 4))


@check(
    "concat_rows",
    """select c_custkey as id, c_acctbal as balance, c_mktsegment as segment from customer
       union all select s_suppkey, s_acctbal, null from supplier""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey as id", "c_acctbal as balance", "c_mktsegment as segment")
    s = table(spark, sf, "supplier").selectExpr("s_acctbal as balance", "s_suppkey as id")
    return rel.concat_rows([c, s])
