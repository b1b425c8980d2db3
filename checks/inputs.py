"""Test tables, and school-shaped views derived from them.

Each view is one SQL text in the common part of Spark's and DuckDB's dialects, so both
sides of a check start from the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, release) -> DataFrame:
    """The rows, written to the shared folder and read back, with the frames they came from let go."""
    path = work_path(df.sparkSession, "result")
    df.write.parquet(path)
    release()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rounded(c: str | Column, digits: int = 6) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, digits)


# Two services share a site; some have no site code; some have no teachers.
REGISTER = """
select lpad(cast(c_custkey as string), 7, '0') as "COD_MOD",
       case when c_custkey % 97 = 5 then null
            else lpad(cast(c_custkey - c_custkey % 2 as string), 6, '0') end as "CODLOCAL",
       c_mktsegment as "D_FORMA",
       case when c_nationkey % 2 = 0 then 'Urbana' else 'Rural' end as "DAREACENSO",
       cast(floor(abs(c_acctbal) / 10) as bigint) as "TALUM",
       cast(c_nationkey as bigint) as "TDOC",
       concat('DPTO_', cast(c_nationkey as string)) as "D_DPTO",
       c_custkey as seq
from customer
"""

# Floors as text, unknown use, and sites that state no room type.
CLASSROOMS = """
select lpad(cast(o_custkey - o_custkey % 2 as string), 6, '0') as "CODLOCAL",
       case when o_orderkey % 11 = 0 then '10' else substr(o_orderpriority, 1, 1) end as "P61_2",
       case o_orderstatus when 'F' then '1' when 'O' then '0' else null end as "P61_3",
       case when o_custkey % 10 in (4, 5) then null
            when o_orderstatus = 'P' then '03' when o_orderstatus = 'O' then '01' else '02' end as "P61_4"
from orders
"""

BUILDINGS = """
select lpad(cast(l_partkey - l_partkey % 2 as string), 6, '0') as "CODLOCAL",
       concat('T', cast(l_linenumber % 3 as string)) as "ID_TERR",
       case l_returnflag when 'A' then '1' when 'R' then null else '2' end as "P53_3",
       case when l_linestatus = 'F' then '1' else '2' end as "P53_4",
       case when l_quantity > 25 then '1' else '2' end as "P53_9",
       case when l_linenumber = 7 then null when l_linenumber <= 2 then '11'
            when l_linenumber <= 4 then '12' else '13' end as "P53_10",
       case when l_discount > 0.05 then '1' else '2' end as "P53_13_1",
       case when l_tax > 0.04 then '1' else '2' end as "P53_13_2",
       case when l_linenumber % 2 = 0 then '1' else '2' end as "P53_13_3",
       l_linestatus as "P53_14_3",
       l_returnflag as "P53_18_1"
from lineitem
"""

# Some rows without a site, sites with one subject, levels in mixed case and unknown ones.
HISTORY = """
select cast(case when o_orderkey % 101 = 7 then null else o_custkey - o_custkey % 2 end as double) as "Cod_Local",
       cast(o_orderkey as double) as "Cod_Modular",
       cast(year(o_orderdate) as int) as "AÑO",
       concat('IE ', cast(o_custkey % 50 as string)) as "Nombre_IE",
       case when o_orderkey % 3 = 0 then 'SI' end as "PDL",
       case when o_orderkey % 4 = 0 then 'SI' end as "QM DIRECTO",
       case when o_orderkey % 5 = 0 then 'x' end as "QM INDIRECTO",
       case when o_orderkey % 2 = 0 then 'SI' when o_orderkey % 7 = 0 then 'NO' end as "QM",
       case when o_orderkey % 6 = 0 then 'SI' end as "PDLD",
       case when o_orderkey % 7 = 0 then 'SI' end as "MTESANA",
       case when o_orderkey % 8 = 0 then 'SI' end as "ACADEMIA",
       case when o_orderkey % 2 = 0 then 'Primaria' else 'Secundaria' end as "Nivel",
       o_orderstatus as "Área",
       case when o_custkey % 10 in (2, 3) then 'Lectura' when o_custkey % 10 in (8, 9) then null
            when o_orderstatus = 'P' then 'LECTURA' else 'Matematica' end as "Evaluación",
       case substr(o_orderpriority, 1, 1) when '1' then 'En inicio' when '2' then 'EN PROCESO'
            when '3' then 'Satisfactorio' when '4' then 'En Inicio' end as "Nivel de logro",
       case when month(o_orderdate) <= 6 then 'Entrada' else 'Salida' end as "PERIODO",
       o_orderkey as seq
from orders
"""

DISTANCES = """
select c_custkey - c_custkey % 2 as "CODLOCAL", max(abs(c_acctbal)) / 1000 as "dist_km_utm_log+1"
from customer
group by 1
"""

EVALUATIONS = """
select cast(l_suppkey as string) as id_estudiante,
       concat('IE ', cast(l_partkey % 50 as string)) as nom_ie,
       cast(l_linenumber as string) as grado,
       l_returnflag as "Programa",
       l_linestatus as cuadernillo,
       case when l_tax > 0.04 then 'Lectura' else 'Matematica' end as area_evaluacion,
       l_quantity as suma_puntaje,
       cast(l_linenumber as double) as tot_preguntas,
       case when l_tax = 0 then null else l_discount * 100 end as porcentaje_promedio,
       case when l_orderkey % 5 = 0 then null else concat('R', cast(l_suppkey % 4 as string)) end as region,
       concat('U', cast(l_suppkey % 7 as string)) as ugel,
       concat(lpad(cast(l_orderkey as string), 12, '0'), '-', cast(l_linenumber as string), '-',
              cast(l_partkey as string), '-', cast(l_suppkey as string)) as seq
from lineitem
"""

# One row per site, infrastructure as SI / NO, some of it unknown.
MASTER = """
select lpad(cast(c_custkey - c_custkey % 2 as string), 6, '0') as "CODLOCAL",
       max(lpad(cast(c_custkey as string), 7, '0')) as "COD_MOD",
       max(c_mktsegment) as "D_FORMA",
       max(case when c_nationkey % 2 = 0 then 'Urbana' else 'Rural' end) as "DAREACENSO",
       concat('T', cast(max(c_nationkey) % 3 as string)) as "ID_TERR",
       cast(floor(max(abs(c_acctbal)) / 10) as bigint) as "TALUMNO",
       cast(min(c_nationkey) as bigint) as "TDOCENTE",
       cast(count(*) as bigint) as "NROCED",
       max(case when c_nationkey < 12 then 'SI' else 'NO' end) as "P53_3",
       max(case when c_acctbal > 0 then 'SI' else 'NO' end) as "P53_4",
       min(case when c_acctbal > 5000 then 'SI' else 'NO' end) as "P53_9",
       min(case when c_nationkey % 3 = 0 then 'SI' else 'NO' end) as "P53_10",
       max(case when c_nationkey % 4 = 0 then 'SI' when c_nationkey % 4 = 1 then 'NO' end) as "P53_14_3",
       max(case when c_mktsegment = 'BUILDING' then 'SI' end) as "P53_18_1",
       cast(max(c_nationkey) % 4 + 1 as bigint) as "P61_2",
       max(abs(c_acctbal)) / 1000 as "dist_km_utm_log+1"
from customer
group by c_custkey - c_custkey % 2
"""

_VIEWS = {
    "register": (REGISTER, "customer"),
    "classrooms": (CLASSROOMS, "orders"),
    "buildings": (BUILDINGS, "lineitem"),
    "history": (HISTORY, "orders"),
    "distances": (DISTANCES, "customer"),
    "evaluations": (EVALUATIONS, "lineitem"),
    "master": (MASTER, "customer"),
}


def school(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A school-shaped view of the test tables."""
    text, source = _VIEWS[name]
    body, _, tail = text.partition(f"from {source}")
    bound = f"{body}from {{{source}}}{tail}".replace('"', "`")
    return spark.sql(bound, **{source: table(spark, sf_dir, source)})


def with_views(sql: str, *names: str) -> str:
    """SQL text that starts with the named views as common table expressions."""
    parts = ", ".join(f"{n} as ({_VIEWS[n][0].strip()})" for n in names)
    return f"with {parts}{', ' if sql.lstrip().startswith('+') else ' '}{sql.lstrip().removeprefix('+')}"
