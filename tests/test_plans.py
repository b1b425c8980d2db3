"""The school plans end to end on hand-made sources, and every registered query."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from campusgrid.plans import full_run, impact, panel, segments, sites, students
from campusgrid.plans import names as N
from campusgrid.sources import load_any
from checks import model_checks, plan_checks
from checks.compare import compare
from checks.files import dbf_bytes, xlsx_bytes, zip_bytes

from conftest import ROOT, rows

SF = "/root/testdata/sf0.001"
REGISTER = [
    # COD_MOD, CODLOCAL, D_FORMA, DAREACENSO, TALUM, TDOC, D_DPTO, seq
    ("m1", "000001", "Esc", "Urbana", 100, 5, "LIMA", 1),
    ("m2", "000001", "No", "Rural", 1, 1, "PUNO", 2),
    ("m3", "000002", "Esc", "Rural", 50, 0, "PUNO", 3),
    ("m4", None, "Esc", "Rural", 7, 1, "PUNO", 4),
    ("m5", None, "Esc", "Rural", 8, 1, "PUNO", 5),
    ("m6", "000009", "Esc", "Rural", 9, 3, "PUNO", 6),
]
ROOMS = [
    ("000001", "2", "1", "01"), ("000001", "10", None, "02"), ("000001", "x", "0", "01"),
    ("000002", "1", "1", "03"), ("000003", "1", "1", "01"), ("000009", "1", None, None),
]
BUILDINGS = [
    # CODLOCAL, P53_3, P53_4, P53_9, P53_10, P53_13_1, P53_13_2, P53_13_3
    ("000001", "1", "1", "2", "11", "1", None, "2"),
    ("000001", "1", "2", None, "13", "1", "1", "2"),
    ("000002", "2", "2", "2", None, "2", "2", "2"),
    ("000009", "1", "1", "1", "12", "1", "1", "1"),
]
HISTORY = [
    # Cod_Local, PDL, QM DIRECTO, QM INDIRECTO, QM, PDLD, MTESANA, ACADEMIA, Evaluación, Nivel de logro, seq
    (1.0, "SI", None, None, "NO", None, None, "x", "Lectura", "En inicio", 1),
    (1.0, None, "SI", None, None, None, None, None, "LECTURA", "EN PROCESO", 2),
    (2.0, None, None, None, "SI", None, "SI", None, "Matematica", "otro", 3),
    (1234567.0, None, None, None, None, None, None, None, "matematica", "Satisfactorio", 4),
    (None, None, None, None, "SI", None, None, None, "lectura", "Satisfactorio", 5),
    (4.0, None, None, None, None, None, None, None, None, "Satisfactorio", 6),
]
DISTANCES = [("1", 0.5), ("000002", 1.5)]


@pytest.fixture()
def five(spark):
    kinds = {"TALUM": "long", "TDOC": "long", "seq": "long", "Cod_Local": "double"}
    schema = lambda cols: ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in cols)
    return {
        "register": spark.createDataFrame(REGISTER, schema([*N.REGISTER, "seq"])),
        "classrooms": spark.createDataFrame(ROOMS, schema(N.CLASSROOMS)),
        "buildings": spark.createDataFrame(BUILDINGS, schema(N.BUILDINGS)),
        "history": spark.createDataFrame(HISTORY, schema([*N.HISTORY, "seq"])),
        "distances": spark.createDataFrame(DISTANCES, f"CODLOCAL string, `{N.DISTANCE}` double"),
    }


def test_register(five, spread):
    assert rows(sites.site_register(spread(five["register"]), order=["seq"])) == sorted(
        [REGISTER[i][:7] for i in (0, 2, 3, 5)], key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


def test_classrooms(five, spread):
    assert rows(sites.classroom_profile(spread(five["classrooms"]))) == [
        ("000001", 3, 10, 1, 2, 1), ("000002", 1, 1, 1, 0, 0), ("000003", 1, 1, 1, 1, 0), ("000009", 1, 1, 0, None, None),
    ]


def test_buildings(five, spread):
    out = sites.building_profile(spread(five["buildings"]))
    assert out.columns == [N.SITE, "n_edificios", *N.BUILDING_FLAGS, "P531011", "P531012", "P531013"]
    assert rows(out) == [
        ("000001", 2, 2, 1, 0, 2, 1, 0, 1, 0, 1), ("000002", 1, 0, 0, 0, 0, 0, 0, None, None, None),
        ("000009", 1, 1, 1, 1, 1, 1, 1, 0, 1, 0),
    ]


def test_history(five, spread):
    out = sites.achievement_history(spread(five["history"]), order=["seq"])
    assert rows(out) == [
        (None, 0, 0, 0, 1, 0, 0, 0, None, None),
        ("000001", 1, 0, 0, 1, 0, 0, 1, 1.5, 0.0),
        ("000002", 0, 0, 0, 1, 0, 1, 0, 0.0, None),
        ("000004", 0, 0, 0, 0, 0, 0, 0, None, None),
        ("1234567", 0, 0, 0, 0, 0, 0, 0, 0.0, 3.0),
    ]
    by_text = sites.achievement_history(spread(five["history"]).withColumn("seq", F.format_string("%03d", "seq")), order=["seq"])
    assert rows(by_text) == rows(out)


def test_integrated(five, spread):
    out = sites.integrate_sites(
        *[spread(five[n]) for n in ("register", "classrooms", "buildings", "history", "distances")],
        register_order=["seq"], history_order=["seq"],
    )
    found = {r[N.SITE]: r.asDict() for r in out.collect()}
    assert set(found) == {None, "000001", "000002", "000004", "1234567"} and out.count() == 5
    assert found["000001"]["COD_MOD"] == "m1" and found["000001"]["n_aulas"] == 3 and found["000001"][N.DISTANCE] == 0.5
    assert found["000004"]["n_edificios"] is None and found[None]["COD_MOD"] is None
    features = {r[N.SITE]: r for r in segments.site_features(out).collect()}
    assert features["000001"].ratio_alumno_docente == 20.0 and features["000001"].infra_index == 2 + 1 + 0 + 1 + 0 + 2 + 1 + 0
    assert features["000002"].ratio_alumno_docente is None and features["000004"].infra_index == 0


def test_programme_panel(spark, spread):
    data = [
        (1.0, 2024, "SI", None, None, None, "Lectúra ", "En inicio"), (1.0, 2024, "SI", None, None, None, "lectura", "En proceso"),
        (1.0, 2024, None, None, None, None, "Matemática", "Satisfactorio"), (1.0, 2023, "SI", None, None, None, "Lectura", "x"),
        (None, 2024, "SI", None, None, None, "Lectura", "En inicio"),
    ]
    df = spread(spark.createDataFrame(data, "Cod_Local double, `AÑO` int, PDL string, QM string, MTESANA string, ACADEMIA string, `Evaluación` string, `Nivel de logro` string"))
    out = panel.programme_panel(df)
    assert out.columns == ["Cod_Local", "AÑO", "PDL", "QM", "MTESANA_INDIRECTO", "ACADEMIA_DIRECTO", "LECTURA", "MATEMATICA"]
    assert rows(out) == [("000001", 2024, 0, 0, 0, 0, None, 3.0), ("000001", 2024, 1, 0, 0, 0, 1.5, None)]
    master = spark.createDataFrame([("1",), ("2",)], "CODLOCAL string")
    assert panel.modelling_table(master, df, year=2024).count() == 3


def test_student_summary(spark, spread):
    data = [("s1", "A", "1", "P", 2.0, 40.0, None, "u1", 1), ("s1", "A", "1", "P", 4.0, None, "r2", "u2", 2), (None, "A", "1", "P", None, 80.0, "r3", None, 3), ("s9", None, "1", "P", 1.0, 1.0, "r", "u", 4)]
    df = spread(spark.createDataFrame(data, "id_estudiante string, nom_ie string, grado string, Programa string, suma_puntaje double, porcentaje_promedio double, region string, ugel string, seq int"))
    assert rows(students.student_summary(df, order="seq")) == [("A", "1", "P", 2, 60.0, 3.0, "r2", "u1")]


def test_segments_keep_keys(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    data = [(f"{i:06d}", float(rng.normal(5 * (i % 4))), float(rng.normal(-5 * (i % 4)))) for i in range(200)] + [("none", None, 1.0)]
    df = spark.createDataFrame(data, f"{N.SITE} string, a double, b double")
    out = segments.segment(df, ["a", "b"], key=N.SITE, k=4, k_max=5, starts=4)
    assert out.labels.count() == 200 and out.labels.select("cluster").distinct().count() == 4
    assert sum(r.size for r in out.profile.collect()) == 200
    assert sum(r["count"] for r in segments.segment_sizes(out.labels).collect()) == 200
    assert out.points.columns == [N.SITE, "pc1", "pc2", "cluster"] and out.elbow.count() == 4
    overall = sum(r["size"] * r.a for r in out.profile.collect()) / 200
    assert overall == pytest.approx(np.mean([d[1] for d in data[:200]]))


def test_full_study_from_files(spark, tmp_path):
    """Zip with dBASE, zip with workbook, latin-1 text, workbook and CSV through the whole study."""
    n = 120
    code = lambda i: f"{i:06d}"
    fields = [("COD_MOD", "C", 7, 0), ("CODLOCAL", "C", 6, 0), ("D_FORMA", "C", 10, 0), ("DAREACENSO", "C", 10, 0), ("TALUM", "N", 6, 0), ("TDOC", "N", 4, 0), ("D_DPTO", "C", 10, 0)]
    register = [(False, [f"m{i}", code(i), "Esc", "Urbana" if i % 2 else "Rural", str(50 + i * 7 % 90), str(1 + i % 9), "LIMA"]) for i in range(n)]
    register += [(False, ["late", code(0), "Esc", "Urbana", "999", "1", "LIMA"]), (True, ["gone", code(500), "", "", "1", "1", ""])]
    rooms = "CODLOCAL;P61_2;P61_3;P61_4\n" + "\n".join(f"{code(i)};{1 + i % 3};{1 + j % 2};0{1 + j % 3}" for i in range(n) for j in range(1 + i % 4))
    buildings = [list(N.BUILDINGS)] + [[code(i), *[str(1 + (i + c) % 2) for c in range(3)], str(11 + i % 3), *[str(1 + (i * c) % 2) for c in range(3)]] for i in range(n) for _ in range(1 + i % 2)]
    history = [list(N.HISTORY)]
    for i in range(n):
        for subject in ("Lectura", "Matematica"):
            level = ("En inicio", "En proceso", "Satisfactorio")[(i + len(subject)) % 3]
            history.append([i, "SI" if i % 3 else None, None, None, "SI" if i % 2 else None, None, None, None, subject, level])
    files = {
        "register": ("register.zip", zip_bytes({"p.dbf": dbf_bytes(fields, register)})),
        "classrooms": ("rooms.txt", rooms.encode("latin-1")),
        "buildings": ("buildings.zip", zip_bytes({"e.xlsx": xlsx_bytes(buildings)})),
        "history": ("history.xlsx", xlsx_bytes(history)),
        "distances": ("d.csv", ("CODLOCAL,dist_km_utm_log+1\r\n" + "".join(f"{code(i)},{i / 50}\r\n" for i in range(n))).encode()),
    }
    paths = {}
    for name, (file, data) in files.items():
        (tmp_path / file).write_bytes(data)
        paths[name] = str(tmp_path / file)
    result = full_run.run_study(full_run.load_sources(spark, paths), output=str(tmp_path / "out"))
    assert result.sites.count() == n
    assert result.sites.where(f"{N.SITE} = '000000'").first().COD_MOD == "m0"
    assert result.segments.labels.count() == n and sum(r["count"] for r in result.sizes.collect()) == n
    metrics = result.regression.metrics.first()
    assert metrics.n > 5 and metrics.mae is not None
    assert load_any(spark, str(tmp_path / "out" / "segments")).count() == n
    assert "P531011" in load_any(spark, str(tmp_path / "out" / "sites")).columns


def test_impact_identity(spark):
    """For a linear model the mean uplift is the treatment's raw coefficient."""
    data = [(f"{i:06d}", 2024, i % 2, (i * 13) % 7, "Urbana" if i % 3 else "Rural", 1.0 + 0.5 * (i % 2) + 0.1 * ((i * 13) % 7), 1.0 + 0.5 * (i % 2)) for i in range(300)]
    df = spark.createDataFrame(data, f"{N.SITE} string, `AÑO` int, QM int, TALUMNO int, DAREACENSO string, LECTURA double, MATEMATICA double")
    study = impact.impact_study(df)
    assert study.uplift.first().uplift == pytest.approx(0.5, abs=1e-6)
    assert {r.segment for r in study.report.collect()} == {"train", "test"}


# Those of the training-data operators are tested beside them.
@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(registered._CORPUS)))
def test_registered_query(spark, name):
    assert compare(spark, SF, registered.queries()[name], registered.oracle_sql().get(name)) == ""


# More rows show what few rows hide in whatever is fitted.
@pytest.mark.parametrize("name", sorted(set(model_checks.ORACLE) & set(registered.queries())))
def test_fitted_query_on_more_rows(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", registered.queries()[name], registered.oracle_sql()[name]) == ""


def test_entry(spark):
    out = registered.entry(spark)
    assert out.count() > 0 and N.SITE in out.columns


def test_bucketed_tables_are_joined_as_they_lie(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = plan_checks.bucketed_sites(spark, SF)
        assert joined.count() > 0
        plan = joined._jdf.queryExecution().optimizedPlan().toString(), joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Only the history (grouped and joined by its own code) and the distances are dealt out.
    shuffles = [line for line in plan[1].split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) <= 3, "\n".join(shuffles)
    assert plan[1].count("Bucketed: true") >= 3


def test_buckets_grow_in_number_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr("campusgrid.sources.sinks.BUCKET_ROWS", 500)
    found = plan_checks.bucketed_sites(spark, SF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    buckets = {t.name: [r.data_type for r in spark.sql(f"describe extended {t.name}").collect() if r.col_name == "Num Buckets"]
               for t in spark.catalog.listTables() if t.name in plan}
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert len(buckets) == 3 and set(map(tuple, buckets.values())) == {(str(-(-lines // 500)),)}
    assert rows(found) == rows(plan_checks._sites(spark, SF))


OUTSIDE = """
import sys
sys.path.insert(0, {root!r})
from campusgrid.session import build_session
import __spark_entry__ as registered
spark = build_session("local[2]", 2, spark__checkpoint__dir={folder!r})
for name in {names!r}:
    registered.queries()[name](spark, {sf!r}).write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


def test_python_tasks_find_the_package_from_any_folder(tmp_path):
    """Workers have neither the repository on their path nor as working folder."""
    names = ["kmeans_fit", "segments_master", "kernel_density", "lasso_select", "dbf_scan", "zip_scan", "xlsx_scan", "multiline_csv"]
    script = tmp_path / "run.py"
    script.write_text(OUTSIDE.format(root=ROOT, folder=str(tmp_path / "shared"), names=names, sf=SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert [line for line in done.stdout.splitlines() if line.startswith("ran")] == [f"ran {n}" for n in names], done.stderr[-3000:]


def test_exploratory_panel_against_loops(spark, spread):
    """Sections, buildings and classrooms multiply; sites without a row, codes in two forms, and a master that repeats a site."""
    history = [("IE a", 1.0, 2023, "U", "Lectura", "Entrada", level) for level in ("En inicio", "Satisfactorio", "En proceso", "En proceso", "En inicio", "En inicio")]
    history += [("IE a", 2.0, 2023, "U", "Lectura", "Entrada", "x"), ("IE b", 3.0, 2023, "R", "Matematica", "Salida", "En proceso")]
    history = spread(spark.createDataFrame(history, "Nombre_IE string, Cod_Local double, `AÑO` int, `Área` string, `Evaluación` string, PERIODO string, `Nivel de logro` string"))
    tests = [("s1", "IE a", "2", "P", "c1", "Lectura", 1.0), ("s2", "IE a", "2", "P", "c1", "Lectura", 0.0), ("s2", "IE a", "2", "P", "c1", "Lectura", 0.0), ("s3", "IE a", "4", "Q", "c2", "Lectura", 5.0)]
    tests = spread(spark.createDataFrame(tests, "id_estudiante string, nom_ie string, grado string, Programa string, cuadernillo string, area_evaluacion string, suma_puntaje double"))
    tests = tests.withColumns({"tot_preguntas": F.lit(1.0), "porcentaje_promedio": F.lit(2.0)})
    text = lambda cols: ", ".join(f"{c} string" for c in cols)
    register = spread(spark.createDataFrame([("m1", "1", "F1", "U", "10", "1"), ("m2", "000001", "F2", "U", "10", "1"), ("m3", "3", "F3", "U", "7", "1")], text(N.REGISTER_OLD)))
    buildings = spread(spark.createDataFrame([("1", *v) for v in ("abcdefghij", "abcdefghij", "Abcdefghij")], text(N.BUILDINGS_OLD)))
    classrooms = spread(spark.createDataFrame([("1", "1", "1", "01"), ("1", "2", "1", "01"), ("9", "2", "1", "01")], text(N.CLASSROOMS)))
    master = spread(spark.createDataFrame([("1", "70", "x"), ("3", "71", "y"), ("3", "72", "z")], "CODLOCAL string, TALUMNO string, own string"))
    out = panel.exploratory_panel(register, buildings, classrooms, tests, history, master, digits=3)
    sections = {"IE a": [("P", 2, 0.333), ("Q", 1, 5.0)]}
    site = {"000001": [(m, b, c) for m in ("m1", "m2") for b in "aA" for c in "12"], "000003": [("m3", None, None)]}
    places = {"000001": [("70", "x")], "000003": [("71", "y"), ("72", "z")]}
    none = [(None, None, None)]
    want = [
        (name, code, mean, *s, *r, *w)
        for name, code, mean in (("IE a", "000001", 1.667), ("IE a", "000002", None), ("IE b", "000003", 2.0))
        for s in sections.get(name, none) for r in site.get(code, none) for w in places.get(code, [(None, None)])
    ]
    found = out.select("Nombre_IE", "Cod_Local", "promedio_logro", "Programa", "cantidad_alumnos", "promedio_suma_puntaje", "COD_MOD", "ID_TERR", "P61_2", "TALUMNO_master", "own")
    assert rows(found) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert out.columns[:8] == [*panel.history_means(history).columns, "Programa"] and out.columns[-3:] == ["CODLOCAL_master", "TALUMNO_master", "own"]
    # The sections' products are the outermost join: nothing is shuffled or sorted after it.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Nombre_IE" in next(line for line in plan.splitlines() if "Join LeftOuter" in line)
