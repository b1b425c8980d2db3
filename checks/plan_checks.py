"""The composed school plans on school-shaped views of the test tables, and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid.functions import as_column
from campusgrid.plans import full_run, impact, panel, segments, sites, students
from campusgrid.plans import names as N
from campusgrid.session import work_path
from campusgrid.sources import bucket_count, load_any, read_dbf, write_bucketed, write_csv, write_parquet
from campusgrid.sources.quoted import read_quoted

from . import files
from .inputs import rounded, school, settled, table, with_views

QUERIES = {}
ORACLE = {}


def check(name, sql=None):
    def add(make):
        QUERIES[name] = make
        if sql:
            ORACLE[name] = sql
        return make

    return add


_REGISTER = """select "COD_MOD", "CODLOCAL", "D_FORMA", "DAREACENSO", "TALUM", "TDOC", "D_DPTO" from
    (select *, row_number() over (partition by "CODLOCAL" order by seq) as rn from register) where rn = 1"""

_ROOMS = """select "CODLOCAL", count(*) as n_aulas, max(cast("P61_2" as int)) as max_piso,
    sum(coalesce(("P61_3" = '1')::int, 0))::bigint as "P61_3",
    case when count("P61_4") > 0 then count(*) filter (where "P61_4" = '01') end as "P61_401",
    case when count("P61_4") > 0 then count(*) filter (where "P61_4" = '02') end as "P61_402" from classrooms group by 1"""

_BUILDINGS = """select "CODLOCAL", count(*) as n_edificios, {flags},
    case when count("P53_10") > 0 then count(*) filter (where "P53_10" = '11') end as "P531011",
    case when count("P53_10") > 0 then count(*) filter (where "P53_10" = '12') end as "P531012",
    case when count("P53_10") > 0 then count(*) filter (where "P53_10" = '13') end as "P531013"
    from buildings group by 1""".format(
    flags=", ".join(f"""sum(coalesce(("{c}" = '1')::int, 0))::bigint as "{c}" """ for c in N.BUILDING_FLAGS)
)

_CODED = """select *, lpad(cast("Cod_Local" as bigint)::varchar, 6, '0') as site, lower("Evaluación") as subject,
    case lower("Nivel de logro") when 'en inicio' then 1 when 'en proceso' then 2 when 'satisfactorio' then 3 end as level,
    row_number() over (partition by "Cod_Local" order by seq) as rn from history"""


def _subject(s: str, name: str, digits: str = "") -> str:
    mean = f"avg(level) filter (where subject = '{s}')"
    mean = f"round({mean}, 6)" if digits else mean
    return f"case when count(*) filter (where subject = '{s}') = 0 then 0.0 else {mean} end as \"{name}\""


_HISTORY = f"""select f.site as "CODLOCAL", {{flags}}, m."Evaluación_lectura", m."Evaluación_matematica"
    from ({_CODED}) f left join
      (select site, {_subject("lectura", "Evaluación_lectura", "6")}, {_subject("matematica", "Evaluación_matematica", "6")}
       from ({_CODED}) where subject is not null and site is not null group by 1) m on f.site = m.site
    where f.rn = 1""".format(
    flags=", ".join(f"""(f."{c}" is not null)::int as "{N.PROGRAMME_NAMES.get(c, c)}" """ for c in N.PROGRAMMES)
)

_DISTANCES = """select lpad("CODLOCAL"::varchar, 6, '0') as "CODLOCAL", "dist_km_utm_log+1" from distances"""


@check("site_register", with_views(_REGISTER, "register"))
def _(spark, sf):
    return sites.site_register(school(spark, sf, "register"), order=["seq"])


@check("classroom_profile", with_views(_ROOMS, "classrooms"))
def _(spark, sf):
    return sites.classroom_profile(school(spark, sf, "classrooms"))


@check("building_profile", with_views(_BUILDINGS, "buildings"))
def _(spark, sf):
    return sites.building_profile(school(spark, sf, "buildings"))


def _rounded_subjects(df):
    return df.withColumns({n: rounded(as_column(n)) for n in N.SUBJECTS.values()})


@check("achievement_history", with_views(_HISTORY, "history"))
def _(spark, sf):
    return _rounded_subjects(sites.achievement_history(school(spark, sf, "history"), order=["seq"]))


@check("site_distances", with_views(_DISTANCES, "distances"))
def _(spark, sf):
    return sites.site_distances(school(spark, sf, "distances"))


_SITES = f"""+ h as ({_HISTORY}), p as ({_REGISTER}), e as ({_BUILDINGS}), a as ({_ROOMS}), d as ({_DISTANCES})
    select * from h left join (select * from p left join (select * from e left join a using ("CODLOCAL")) i using ("CODLOCAL")) b
    using ("CODLOCAL") left join d using ("CODLOCAL")"""
_FIVE = ("register", "classrooms", "buildings", "history", "distances")


def _sites(spark, sf):
    return sites.integrate_sites(
        *[school(spark, sf, n) for n in _FIVE], register_order=["seq"], history_order=["seq"]
    )


@check("integrate_sites", with_views(_SITES, *_FIVE))
def _(spark, sf):
    return _rounded_subjects(_sites(spark, sf))


def bucketed_sites(spark, sf, buckets=8):
    """The integrated sites, with all detail tables stored in buckets of the site code, ``buckets`` at least."""
    stored = {}
    details = {name: school(spark, sf, name) for name in ("register", "classrooms", "buildings")}
    buckets = bucket_count(details.values(), least=buckets)
    for name, rows in details.items():
        path = work_path(spark, name)
        stored[name] = write_bucketed(rows, path, path.rsplit("/", 1)[1].replace("-", "_"), N.SITE, buckets=buckets)
    rest = [school(spark, sf, n) for n in ("history", "distances")]
    return sites.integrate_sites(*stored.values(), *rest, register_order=["seq"], history_order=["seq"])


@check("integrate_sites_bucketed", with_views(_SITES, *_FIVE))
def _(spark, sf):
    return _rounded_subjects(bucketed_sites(spark, sf))


@check(
    "site_features",
    with_views(
        _SITES.replace("select * from h left join", """select "CODLOCAL", round("TALUM" / nullif("TDOC", 0), 6) as ratio_alumno_docente,
        """ + " + ".join(f'coalesce("{c}", 0)' for c in N.INFRA) + """ as infra_index from h left join""", 1),
        *_FIVE,
    ),
)
def _(spark, sf):
    out = segments.site_features(_sites(spark, sf))
    return out.select(N.SITE, rounded("ratio_alumno_docente").alias("ratio_alumno_docente"), "infra_index")


@check(
    "master_features",
    with_views(
        """select "CODLOCAL", round("TALUMNO" / nullif("TDOCENTE", 0), 6) as ratio_alumno_docente, """
        + " + ".join(f"""coalesce(case "{c}" when 'SI' then 1 when 'NO' then 0 end, 0)""" for c in N.INFRA_YES_NO)
        + " as infra_index from master",
        "master",
    ),
)
def _(spark, sf):
    out = segments.master_features(school(spark, sf, "master"))
    return out.select(N.SITE, rounded("ratio_alumno_docente").alias("ratio_alumno_docente"), "infra_index")


_SECTIONS = """select "Programa", nom_ie, grado, cuadernillo, area_evaluacion, count(distinct id_estudiante) as cantidad_alumnos,
    round(avg(suma_puntaje), 6) as promedio_suma_puntaje, round(avg(tot_preguntas), 6) as promedio_tot_preguntas,
    round(avg(porcentaje_promedio), 6) as promedio_porcentaje from evaluations group by 1, 2, 3, 4, 5"""


@check("section_results", with_views(_SECTIONS, "evaluations"))
def _(spark, sf):
    out = panel.section_results(school(spark, sf, "evaluations"))
    means = ["promedio_suma_puntaje", "promedio_tot_preguntas", "promedio_porcentaje"]
    return out.withColumns({m: rounded(m) for m in means})


@check(
    "history_means",
    with_views(
        """select "Nombre_IE", "Cod_Local", "AÑO", "Área", "Evaluación", "PERIODO", round(avg(case lower("Nivel de logro")
             when 'en inicio' then 1 when 'en proceso' then 2 when 'satisfactorio' then 3 end), 6) as promedio_logro
           from history where "Cod_Local" is not null and "Evaluación" is not null group by 1, 2, 3, 4, 5, 6""",
        "history",
    ),
)
def _(spark, sf):
    out = panel.history_means(school(spark, sf, "history"))
    return out.withColumn("promedio_logro", rounded("promedio_logro"))


# The panel joins many-to-many: a few sites share a school name, and every column varies, but with two or three descriptions
# for a site and name, as sections, buildings and classrooms multiply.
_PANEL = {
    "register": """select cast(o_orderkey as string) as "COD_MOD", cast(o_orderkey as string) as "CODLOCAL", o_orderstatus as "D_FORMA",
        'Urbana' as "DAREACENSO", o_custkey as "TALUMNO", o_custkey % 7 as "TDOCENTE" from orders""",
    "buildings": """select cast(l_orderkey as string) as "CODLOCAL", 'T1' as "ID_TERR", l_returnflag as "P53_3", l_linestatus as "P53_4",
        case when l_returnflag = 'A' then '1' else '2' end as "P53_9", case l_returnflag when 'A' then '11' when 'N' then '12' else '13' end as "P53_10",
        l_linestatus as "P53_14_3", l_returnflag as "P53_18_1", case when l_returnflag = 'R' then '1' else '2' end as "P53_13_1",
        case when l_linestatus = 'O' then '1' else '2' end as "P53_13_2", case when l_returnflag = 'N' then '1' else '2' end as "P53_13_3"
        from lineitem""",
    "classrooms": """select cast(l_orderkey as string) as "CODLOCAL", case when l_linestatus = 'F' then '1' else '2' end as "P61_2",
        l_linestatus as "P61_3", case when l_linestatus = 'F' then '01' else '02' end as "P61_4" from lineitem""",
    "evaluations": """select cast(l_suppkey as string) as id_estudiante, concat('IE ', cast(floor(l_orderkey / 2) as string)) as nom_ie, case when l_linestatus = 'F' then '2' else '4' end as grado,
        l_returnflag as "Programa", l_linestatus as cuadernillo, case when l_tax > 0.04 then 'Lectura' else 'Matematica' end as area_evaluacion, l_quantity as suma_puntaje,
        l_tax as tot_preguntas, l_discount as porcentaje_promedio from lineitem""",
    "history": """select cast(o_orderkey as double) as "Cod_Local", cast(year(o_orderdate) as int) as "AÑO",
        concat('IE ', cast(floor(o_orderkey / 2) as string)) as "Nombre_IE", o_orderstatus as "Área",
        case when o_custkey % 2 = 0 then 'Lectura' else 'Matematica' end as "Evaluación",
        case substr(o_orderpriority, 1, 1) when '1' then 'En inicio' when '2' then 'EN PROCESO' else 'x' end as "Nivel de logro",
        case when month(o_orderdate) <= 6 then 'Entrada' else 'Salida' end as "PERIODO" from orders""",
    "master": """select cast(o_orderkey as string) as "CODLOCAL", o_totalprice as "dist_km_utm_log+1", o_custkey as "TALUMNO" from orders""",
}


def _panel_view(spark, sf, name):
    text = _PANEL[name].replace('"', "`")
    source = text.rsplit("from ", 1)[1]
    return spark.sql(text.removesuffix(source) + "{" + source + "}", **{source: table(spark, sf, source)})


@check(
    "exploratory_panel",
    "with "
    + ", ".join(f"{n} as ({t})" for n, t in _PANEL.items())
    + """, means as (select "Nombre_IE", lpad(cast("Cod_Local" as bigint)::varchar, greatest(6, length(cast("Cod_Local" as bigint)::varchar))::int, '0') as site,
             "AÑO", "Área", "Evaluación", "PERIODO",
             avg(case lower("Nivel de logro") when 'en inicio' then 1 when 'en proceso' then 2 when 'satisfactorio' then 3 end) as promedio_logro
           from history group by 1, 2, 3, 4, 5, 6),
         sections as (select "Programa", nom_ie, grado, cuadernillo, area_evaluacion, count(distinct id_estudiante) as cantidad_alumnos,
             avg(suma_puntaje) as puntaje from evaluations group by 1, 2, 3, 4, 5),
         bs as (select distinct * from buildings), cs as (select distinct * from classrooms),
         rows as (select m.*, s.*, r."COD_MOD", r."D_FORMA", r."TALUMNO", b."P53_3", b."P53_9", c."P61_2", c."P61_3" from means m
           left join sections s on m."Nombre_IE" = s.nom_ie
           left join (select distinct lpad("CODLOCAL", greatest(6, length("CODLOCAL"))::int, '0') as site, * from register) r on m.site = r.site
           left join bs b on r."CODLOCAL" = b."CODLOCAL" left join cs c on r."CODLOCAL" = c."CODLOCAL")
       select x.site as "Cod_Local", x."AÑO", x."Área", x."Evaluación", x."PERIODO", round(x.promedio_logro, 6) as promedio_logro, x."Programa",
              x.grado, x.cuadernillo, x.area_evaluacion, x.cantidad_alumnos,
              round(x.puntaje, 6) as promedio_suma_puntaje, x."COD_MOD", x."D_FORMA", x."P53_3", x."P53_9", x."P61_2", x."P61_3", x."TALUMNO",
              w."TALUMNO" as "TALUMNO_master", w."dist_km_utm_log+1"
       from rows x left join (select lpad("CODLOCAL", greatest(6, length("CODLOCAL"))::int, '0') as site, * from master) w on x.site = w.site""",
)
def _(spark, sf):
    names = ("register", "buildings", "classrooms", "evaluations", "history", "master")
    out = panel.exploratory_panel(*[_panel_view(spark, sf, n) for n in names], digits=6)
    return out.select(
        "Cod_Local", "AÑO", "Área", "Evaluación", "PERIODO", "promedio_logro", "Programa", "grado", "cuadernillo", "area_evaluacion",
        "cantidad_alumnos", "promedio_suma_puntaje", "COD_MOD", "D_FORMA", "P53_3", "P53_9", "P61_2", "P61_3", "TALUMNO",
        "TALUMNO_master", as_column(N.DISTANCE),
    )


@check(
    "panel_means",
    f"""select "Evaluación", "Programa", "D_FORMA", count(*) as rows, round(avg(promedio_logro), 3) as promedio_logro,
               round(avg(promedio_suma_puntaje), 3) as promedio_suma_puntaje, round(avg("TALUMNO"), 3) as "TALUMNO",
               round(avg("dist_km_utm_log+1"), 3) as "dist_km_utm_log+1" from ({ORACLE["exploratory_panel"]}) group by 1, 2, 3""",
)
def _(spark, sf):
    out = panel.panel_means(*[_panel_view(spark, sf, n) for n in ("register", "buildings", "classrooms", "evaluations", "history", "master")])
    means = ["promedio_logro", "promedio_suma_puntaje", "TALUMNO", N.DISTANCE]
    return out.select("Evaluación", "Programa", "D_FORMA", "rows", *[F.round(as_column(c), 3).alias(c) for c in means])


_PROGRAMMES = """(select lpad(cast("Cod_Local" as bigint)::varchar, 6, '0') as "Cod_Local", "AÑO", ("PDL" is not null)::int as "PDL",
    ("QM" is not null)::int as "QM", ("MTESANA" is not null)::int as "MTESANA_INDIRECTO", ("ACADEMIA" is not null)::int as "ACADEMIA_DIRECTO",
    round(avg(case lower("Nivel de logro") when 'en inicio' then 1 when 'en proceso' then 2 when 'satisfactorio' then 3 end)
      filter (where upper("Evaluación") = 'LECTURA'), 6) as "LECTURA",
    round(avg(case lower("Nivel de logro") when 'en inicio' then 1 when 'en proceso' then 2 when 'satisfactorio' then 3 end)
      filter (where upper("Evaluación") = 'MATEMATICA'), 6) as "MATEMATICA"
    from history where "Cod_Local" is not null group by 1, 2, 3, 4, 5, 6)"""


@check(
    "programme_panel",
    with_views(f"""select * from {_PROGRAMMES} where "LECTURA" is not null or "MATEMATICA" is not null""", "history"),
)
def _(spark, sf):
    out = panel.programme_panel(school(spark, sf, "history"))
    return out.withColumns({c: rounded(c) for c in N.SUBJECTS_PANEL})


@check(
    "modelling_table",
    with_views(
        f"""select m."CODLOCAL", m."TALUMNO", p.* from master m left join (select * from {_PROGRAMMES}
            where "AÑO" = 1998 and ("LECTURA" is not null or "MATEMATICA" is not null)) p on m."CODLOCAL" = p."Cod_Local" """,
        "history",
        "master",
    ),
)
def _(spark, sf):
    out = panel.modelling_table(school(spark, sf, "master"), school(spark, sf, "history"), year=1998)
    out = out.withColumns({c: rounded(c) for c in N.SUBJECTS_PANEL})
    return out.select(
        N.SITE, "TALUMNO", "Cod_Local", "AÑO", "PDL", "QM", "MTESANA_INDIRECTO", "ACADEMIA_DIRECTO", *N.SUBJECTS_PANEL
    )


_SUMMARY = """select nom_ie, grado, "Programa", count(id_estudiante) as n_estudiantes, avg(porcentaje_promedio) as porcentaje_promedio,
    avg(suma_puntaje) as suma_puntaje, arg_min(region, seq) filter (where region is not null) as region,
    arg_min(ugel, seq) filter (where ugel is not null) as ugel from evaluations group by 1, 2, 3"""


@check(
    "student_summary",
    with_views(
        f"select * replace (round(porcentaje_promedio, 6) as porcentaje_promedio, round(suma_puntaje, 6) as suma_puntaje) from ({_SUMMARY})",
        "evaluations",
    ),
)
def _(spark, sf):
    out = students.student_summary(school(spark, sf, "evaluations"), order="seq")
    return out.withColumns({c: rounded(c) for c in ("porcentaje_promedio", "suma_puntaje")})


@check(
    "best_schools",
    with_views(
        f"""select nom_ie, grado, "Programa", n_estudiantes, round(porcentaje_promedio, 6) as porcentaje from ({_SUMMARY})
            where n_estudiantes > 5 and porcentaje_promedio is not null
            order by porcentaje_promedio desc, nom_ie, grado, "Programa" limit 15""",
        "evaluations",
    ),
)
def _(spark, sf):
    made = students.student_reports(school(spark, sf, "evaluations"), order="seq")
    best = settled(made.best(), made.release)
    return best.select("nom_ie", "grado", "Programa", "n_estudiantes", rounded("porcentaje_promedio").alias("porcentaje"))


@check(
    "scores_by_grade",
    with_views(
        f"""select nom_ie, grado, sum(n_estudiantes)::bigint as n_estudiantes,
                   round(sum(porcentaje_promedio * n_estudiantes) / sum(n_estudiantes) filter (where porcentaje_promedio is not null), 6)
                   as porcentaje_promedio from ({_SUMMARY}) group by 1, 2""",
        "evaluations",
    ),
)
def _(spark, sf):
    made = students.student_reports(school(spark, sf, "evaluations"), order="seq")
    out = settled(made.by_grade(), made.release)
    return out.withColumn("porcentaje_promedio", rounded("porcentaje_promedio"))


@check(
    "student_description",
    with_views(
        " union all ".join(
            f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(quantile_cont({c}, 0.5), 4) as q50,
                round(max({c}), 4)::double as max from ({_SUMMARY})"""
            for c in ("n_estudiantes", "porcentaje_promedio", "suma_puntaje")
        ),
        "evaluations",
    ),
)
def _(spark, sf):
    made = students.student_reports(school(spark, sf, "evaluations"), order="seq")
    out = settled(made.description(), made.release)
    return out.select("column", "count", *[rounded(c, 4).alias(c) for c in ("mean", "q50", "max")])


@check(
    "programme_schools",
    with_views("""select "Nombre_IE", count(*) as count from history where "QM" = 'SI' group by 1""", "history"),
)
def _(spark, sf):
    return students.programme_schools(school(spark, sf, "history"))


@check("segments_master")
def _(spark, sf):
    features = segments.master_features(school(spark, sf, "master"))
    found = segments.segment(features, N.SEGMENT_FEATURES_MASTER, key=N.SITE)
    return settled(found.labels, found.release)


@check("segments_profile")
def _(spark, sf):
    features = segments.master_features(school(spark, sf, "master"))
    found = segments.segment(features, N.SEGMENT_FEATURES_MASTER, key=N.SITE)
    return settled(found.profile, found.release)


def _modelling(spark, sf):
    return panel.modelling_table(school(spark, sf, "master"), school(spark, sf, "history"), year=1998)


@check("impact_report")
def _(spark, sf):
    study = impact.impact_study(_modelling(spark, sf), year=1998)
    return settled(study.report, study.release)


@check("impact_uplift")
def _(spark, sf):
    study = impact.impact_study(_modelling(spark, sf), year=1998)
    return settled(study.uplift, study.release)


@check("impact_interactions")
def _(spark, sf):
    return impact.interaction_model(_modelling(spark, sf)).terms


@check("impact_selection")
def _(spark, sf):
    return impact.select_features(_modelling(spark, sf), ["TALUMNO", "TDOCENTE", "QM", "PDL", N.DISTANCE, "P61_2"])


@check("impact_trees")
def _(spark, sf):
    run = impact.nonlinear_run(_modelling(spark, sf), ["TALUMNO", "TDOCENTE", "QM", N.DISTANCE], ["D_FORMA", "DAREACENSO"])
    return run.metrics


@check("impact_progressive")
def _(spark, sf):
    return impact.progressive_comparison(_modelling(spark, sf))


@check("full_study")
def _(spark, sf):
    sources = {n: school(spark, sf, n) for n in _FIVE}
    for name in ("register", "history"):
        sources[name] = sources[name].withColumnRenamed("seq", "_load_order")
    study = full_run.run_study(sources)
    return settled(study.regression.metrics, study.release)


# A school per customer: its nation's number decides size, floors, distance and levels, so segments are apart and the
# segment explains the target.
_PLANTED = {
    "register": """select 'm' || lpad(cast(c_custkey as string), 6, '0') as "COD_MOD", lpad(cast(c_custkey as string), 6, '0') as "CODLOCAL", 'Esc' as "D_FORMA",
        'Urbana' as "DAREACENSO", cast(100 + 100 * (c_nationkey % 4) as bigint) as "TALUM", cast(10 as bigint) as "TDOC", 'LIMA' as "D_DPTO",
        c_custkey as _load_order from customer""",
    "classrooms": """select lpad(cast(c_custkey as string), 6, '0') as "CODLOCAL", cast(1 + c_nationkey % 4 as string) as "P61_2", '1' as "P61_3",
        '01' as "P61_4" from customer""",
    "buildings": """select lpad(cast(c_custkey as string), 6, '0') as "CODLOCAL", '1' as "P53_3", '1' as "P53_4", '2' as "P53_9", '11' as "P53_10",
        '1' as "P53_13_1", '2' as "P53_13_2", '1' as "P53_13_3" from customer""",
    "history": """select cast(c_custkey as double) as "Cod_Local", 'SI' as "PDL", cast(null as string) as "QM DIRECTO", cast(null as string) as "QM INDIRECTO",
        'SI' as "QM", cast(null as string) as "PDLD", cast(null as string) as "MTESANA", cast(null as string) as "ACADEMIA",
        case when kind = 0 then 'Lectura' else 'Matematica' end as "Evaluación",
        case when c_nationkey % 4 = 0 then 'En inicio' when c_nationkey % 4 = 1 then 'En proceso' when c_nationkey % 4 = 2 or kind = 0 then 'Satisfactorio'
             else 'En proceso' end as "Nivel de logro", c_custkey * 2 + kind as _load_order
        from customer, (select 0 as kind union all select 1 as kind)""",
    "distances": """select lpad(cast(c_custkey as string), 6, '0') as "CODLOCAL", cast(c_nationkey % 4 as double) as "dist_km_utm_log+1" from customer""",
}


@check(
    "study_planted",
    """with t as (select c_nationkey % 4 as g, ('0x' || substr(md5(lpad(c_custkey::varchar, 6, '0')), 1, 8))::bigint % 10000 < 2000 as test from customer),
            s as (select g, count(*) as n from t group by g)
       select g::int as cluster, n as count, 1.0::double as r2, 0.0::double as mae, (select count(*) from t where test) as n from s""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer")
    sources = {n: spark.sql(text.replace('"', "`").replace("from customer", "from {customer}"), customer=customer) for n, text in _PLANTED.items()}
    study = full_run.run_study(sources)
    metrics = study.regression.metrics.select(rounded("r2").alias("r2"), rounded("mae", 4).alias("mae"), "n")
    r2, mae, n = metrics.first()
    return settled(study.sizes.select("*", F.lit(r2).alias("r2"), F.lit(mae).alias("mae"), F.lit(n).cast("bigint").alias("n")), study.release)


@check(
    "impact_planted",
    """with t as (select lpad(c_custkey::varchar, 6, '0') as "CODLOCAL", (1 + 0.5 * (c_custkey % 2) + 0.01 * c_nationkey + 0.25 * (c_custkey % 3 = 0)::int)::double as y
                  from customer)
       select "CODLOCAL", case when ('0x' || substr(md5("CODLOCAL"), 1, 8))::bigint % 10000 < 2000 then 'test' else 'train' end as segment,
              round(y, 6) as actual, round(y, 4) as prediction, 0.0::double as abs_error, 0.5::double as uplift from t""",
)
def _(spark, sf):
    """Scores that are linear in the treatment and two other columns: the study returns the treatment's effect."""
    rows = table(spark, sf, "customer").selectExpr(
        "lpad(string(c_custkey), 6, '0') as CODLOCAL", "2024 as `AÑO`", "int(c_custkey % 2) as QM", "c_nationkey as TALUMNO",
        "if(c_custkey % 3 = 0, 'Urbana', 'Rural') as DAREACENSO", "1 + 0.5D * (c_custkey % 2) + 0.01D * c_nationkey + 0.25D * int(c_custkey % 3 = 0) as LECTURA",
        "cast(null as double) as MATEMATICA",
    )
    study = impact.impact_study(rows)
    effect = study.uplift.first()["uplift"]
    report = study.report.select(
        N.SITE, "segment", rounded("actual").alias("actual"), rounded("prediction", 4).alias("prediction"),
        F.abs(rounded("abs_error", 4)).alias("abs_error"), F.lit(round(effect, 6)).alias("uplift"),
    )
    return settled(report, study.release)


@check("csv_round_trip", "select * from orders")
def _(spark, sf):
    o = table(spark, sf, "orders")
    path = work_path(spark, "orders-csv")
    write_csv(o, path)
    return load_any(spark, path, schema=o.schema)


@check(
    "latin_semicolon_round_trip",
    """select c_custkey::varchar as codigo, replace(c_name, 'Customer', 'Colegio Ñandú; ') as nombre,
              case when c_mktsegment = 'BUILDING' then null else c_mktsegment end as forma from customer""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("codigo"),
        F.replace("c_name", F.lit("Customer"), F.lit("Colegio Ñandú; ")).alias("nombre"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("forma"),
    )
    path = work_path(spark, "customer-csv")
    write_csv(c, path, separator=";", encoding="ISO-8859-1")
    return load_any(spark, path)


@check("parquet_round_trip", "select * from lineitem")
def _(spark, sf):
    path = work_path(spark, "lineitem-parquet")
    write_parquet(table(spark, sf, "lineitem"), path, partition_by=["l_returnflag"])
    return spark.read.parquet(path).select(*table(spark, sf, "lineitem").columns)


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


def _cells(rows, names):
    return [names, *rows[names].values.tolist()]


_CUSTOMERS = "select {} from customer"


@check("dbf_scan", _CUSTOMERS.format("c_custkey::bigint as KEY, c_name as NAME, c_mktsegment as SEGMENT, c_nationkey::bigint as NATION"))
def _(spark, sf):
    def encode(rows):
        fields = [("KEY", "N", 10, 0), ("NAME", "C", 40, 0), ("SEGMENT", "C", 20, 0), ("NATION", "N", 4, 0)]
        return files.dbf_bytes(fields, [(False, files.texts(row)) for row in rows.values.tolist()])

    return load_any(spark, files.write_as(_customers(spark, sf), "dbf", ".dbf", encode))


@check(
    "dbf_filtered",
    """select c_custkey, c_name, c_mktsegment as segment from customer
       where c_custkey > 40 and c_mktsegment in ('BUILDING', 'MACHINERY') and c_name like 'Customer%'""",
)
def _(spark, sf):
    def encode(rows):
        fields = [("c_custkey", "N", 10, 0), ("c_name", "C", 25, 0), ("segment", "C", 10, 0)]
        return files.dbf_bytes(fields, [(False, files.texts(r)) for r in rows[[f[0] for f in fields]].itertuples(index=False)])

    rows = _customers(spark, sf).withColumnRenamed("c_mktsegment", "segment")
    found = read_dbf(spark, files.write_as(rows, "dbf", ".dbf", encode), records_per_task=500)
    return found.where("c_custkey > 40 and segment in ('BUILDING', 'MACHINERY') and c_name like 'Customer%'")


@check("xlsx_scan", _CUSTOMERS.format("c_custkey::varchar as c_custkey, c_name, c_mktsegment"))
def _(spark, sf):
    encode = lambda rows: files.xlsx_bytes(_cells(rows, ["c_custkey", "c_name", "c_mktsegment"]))
    return load_any(spark, files.write_as(_customers(spark, sf), "xlsx", ".xlsx", encode))


@check("zip_scan", _CUSTOMERS.format("c_custkey::varchar as c_custkey, c_name, c_nationkey::varchar as c_nationkey"))
def _(spark, sf):
    def encode(rows):
        return files.zip_bytes({"read.me": "x", "t.csv": rows[["c_custkey", "c_name", "c_nationkey"]].to_csv(index=False)})

    return load_any(spark, files.write_as(_customers(spark, sf), "zip", ".zip", encode))


@check("multiline_csv", _CUSTOMERS.format("c_custkey::varchar as c_custkey, concat(c_name, chr(10), '\"', c_mktsegment) as note"))
def _(spark, sf):
    note = F.concat("c_name", F.lit("\n\""), "c_mktsegment").alias("note")
    rows = _customers(spark, sf).select("c_custkey", note)
    return load_any(spark, files.write_as(rows, "multiline", ".csv", lambda rows: rows.to_csv(index=False).encode()))


@check("quoted_csv_ranges", "select o_orderkey::varchar as o_orderkey, concat(o_orderstatus, chr(10), '\"', o_orderpriority, '\",') as note from orders")
def _(spark, sf):
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('",')).alias("note")
    rows = table(spark, sf, "orders").select("o_orderkey", note)
    path = files.write_as(rows, "quoted", ".csv", lambda rows: rows.to_csv(index=False).encode(), files=2)
    return read_quoted(spark, path, ["o_orderkey", "note"], range_bytes=1 << 14)


@check(
    "mixed_headers",
    _CUSTOMERS.format("c_custkey::varchar as c_custkey, c_name, case when c_nationkey % 2 = 0 then c_mktsegment end as c_mktsegment"),
)
def _(spark, sf):
    rows = _customers(spark, sf)
    plain = files.write_as(
        rows.where("c_nationkey % 2 = 1").select("c_custkey", "c_name"), "plain", ".csv", lambda rows: rows.to_csv(index=False).encode()
    )
    more = files.write_as(
        rows.where("c_nationkey % 2 = 0").select("c_name", "c_custkey", "c_mktsegment"), "more", ".csv",
        lambda rows: rows.to_csv(index=False).encode(),
    )
    return load_any(spark, [plain, more])


@check("odd_path_latin1", _CUSTOMERS.format("c_custkey::varchar as c_custkey, concat('cañón ', c_name) as name"))
def _(spark, sf):
    rows = _customers(spark, sf).select("c_custkey", F.concat(F.lit("cañón "), "c_name").alias("name"))
    return load_any(spark, files.write_as(rows, "odd +path", " x%20.csv", lambda rows: rows.to_csv(index=False).encode("latin-1")))


@check("file_order_keep_first", "select * from orders")
def _(spark, sf):
    o = table(spark, sf, "orders")
    path = work_path(spark, "ordered-csv")
    write_csv(o, path)
    loaded = load_any(spark, path, schema=o.schema, order_col="_load_order")
    doubled = loaded.unionByName(loaded)
    from campusgrid.operators.relational import keep_first

    return keep_first(doubled, "o_orderkey", ["_load_order"]).drop("_load_order")
