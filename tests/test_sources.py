"""Readers and sinks on files written by the tests."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from campusgrid import sources
from checks.files import dbf_bytes, xlsx_bytes, zip_bytes

from conftest import rows

FIELDS = [("CODLOCAL", "C", 8, 0), ("NOMBRE", "C", 12, 0), ("TALUM", "N", 6, 0), ("NOTA", "N", 8, 2), ("ALTA", "D", 8, 0), ("ACTIVO", "L", 1, 0), ("MEMO", "M", 10, 0)]
RECORDS = [
    (False, ["015676", "Ñandú", "12", "3.50", "20240131", "T", ""]),
    (True, ["999999", "borrado", "1", "1.00", "20240101", "F", ""]),
    (False, ["000001", "", "", "", "", "?", ""]),
    (False, ["0041", "José", "7.", "-1.25", "20231231", "n", ""]),
    (False, ["0042", "x", "******", "1,5", "00000000", "F", ""]),
]
TABLE = [
    ("015676", "Ñandú", 12, 3.5, datetime.date(2024, 1, 31), True, None),
    ("000001", "", None, None, None, None, None),
    ("0041", "José", 7, -1.25, datetime.date(2023, 12, 31), False, None),
    ("0042", "x", None, 1.5, None, False, None),
]


@pytest.fixture()
def put(tmp_path):
    def write(name, data):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
        return str(path)

    return write


def test_dbf(spark, put):
    path = put("padron.dbf", dbf_bytes(FIELDS, RECORDS))
    df = sources.read_dbf(spark, path, order_col="seq").orderBy("seq")
    assert [tuple(r) for r in df.drop("seq").collect()] == TABLE
    assert [r.seq for r in df.collect()] == [0, 2, 3, 4]
    assert dict(df.dtypes)["TALUM"] == "bigint" and dict(df.dtypes)["NOTA"] == "double"
    few = sources.read_dbf(spark, path, columns=["NOTA", "CODLOCAL"])
    assert few.columns == ["NOTA", "CODLOCAL"] and rows(few) == rows(df.select("NOTA", "CODLOCAL"))


def test_dbf_is_split_by_records(spark, put):
    many = [(i % 10 == 3, [f"{i:06d}", "x", str(i), "1.00", "", "T", ""]) for i in range(1000)]
    path = put("big.dbf", dbf_bytes(FIELDS, many))
    df = sources.read_dbf(spark, path, order_col="seq", records_per_task=64)
    assert df.rdd.getNumPartitions() == 16
    assert df.count() == 900 and df.agg(F.sum("TALUM")).first()[0] == sum(i for i in range(1000) if i % 10 != 3)
    assert df.where("seq <> TALUM").count() == 0


def test_dbf_folder_and_empty_table(spark, put):
    put("d/a.dbf", dbf_bytes(FIELDS, RECORDS[:1]))
    path = put("d/b.dbf", dbf_bytes(FIELDS, []))
    folder = path.rsplit("/", 1)[0]
    assert sources.read_dbf(spark, folder).count() == 1
    assert sources.read_dbf(spark, path).count() == 0


def test_dbf_unknown_type(spark, put):
    path = put("odd.dbf", dbf_bytes([("P", "P", 4, 0)], []))
    with pytest.raises(Exception, match="not supported"):
        sources.read_dbf(spark, path).count()


SHEET = [["Cod_Local", "Evaluación", None, "n"], [15676, "Lectura & más", None, 1.5], [None, None, None, None], [None, "NA", "x", 2], [7, None, None, "a<b"]]
SHEET_ROWS = [("15676", "Lectura & más", "1.5"), (None, None, "2"), ("7", None, "a<b")]


@pytest.mark.parametrize("inline", [False, True])
def test_xlsx(spark, put, inline):
    path = put("u.xlsx", xlsx_bytes(SHEET, inline=inline))
    df = sources.read_xlsx(spark, path, order_col="seq").orderBy("seq")
    assert df.columns == ["Cod_Local", "Evaluación", "n", "seq"]
    assert [tuple(r)[:3] for r in df.collect()] == SHEET_ROWS
    typed = sources.read_xlsx(spark, path, schema=StructType.fromDDL("n double, Cod_Local bigint"))
    assert rows(typed) == [(None, 7), (1.5, 15676), (2.0, None)]


def test_xlsx_many_files_and_missing_column(spark, put):
    for i in range(3):
        path = put(f"w/{i}.xlsx", xlsx_bytes([["k", "v"], [i, "a"]], sheet=f"xl/worksheets/s{i}.xml"))
    folder = path.rsplit("/", 1)[0]
    assert rows(sources.read_xlsx(spark, folder)) == [("0", "a"), ("1", "a"), ("2", "a")]
    with pytest.raises(Exception, match="not in the sheet"):
        sources.read_xlsx(spark, folder, schema=StructType.fromDDL("zz string")).count()


def test_zip_prefers_dbf(spark, put):
    path = put("a.zip", zip_bytes({"x.csv": "a,b\n1,2\n", "read.me": "", "T.DBF": dbf_bytes(FIELDS, RECORDS)}))
    df = sources.load_any(spark, path, order_col="seq").orderBy("seq")
    assert [tuple(r)[:-1] for r in df.collect()] == TABLE
    assert [(r.kind, r.member) for r in sources.recognise(spark, path).collect()] == [("zip-dbf", "T.DBF")]


def test_zip_with_workbook_and_with_csv(spark, put):
    path = put("b.zip", zip_bytes({"z.csv": "a\n1\n", "u.xlsx": xlsx_bytes(SHEET)}))
    assert rows(sources.load_any(spark, path)) == sorted(SHEET_ROWS, key=str) or sources.load_any(spark, path).count() == 3
    for text in ("utf-8", "latin-1"):
        data = 'nombre,"n, x"\nÑandú,01\nJosé,\n'.encode(text)
        path = put(f"{text}.zip", zip_bytes({"notes.txt": "", "d/t.CSV": data}))
        df = sources.load_any(spark, path)
        assert df.columns == ["nombre", "n, x"] and rows(df) == [("José", None), ("Ñandú", "01")]


def test_zip_without_table(spark, put):
    path = put("c.zip", zip_bytes({"readme.txt": "x"}))
    with pytest.raises(ValueError, match="readme.txt"):
        sources.load_any(spark, path)


def test_bare_workbook_and_old_workbook(spark, put):
    assert sources.load_any(spark, put("noext", xlsx_bytes(SHEET))).count() == 3
    with pytest.raises(ValueError, match="legacy"):
        sources.load_any(spark, put("old.xls", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 100))


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
@pytest.mark.parametrize("separator", [",", ";", "\t", "|"])
def test_text_encoding_and_delimiter(spark, put, encoding, separator):
    lines = [["CODLOCAL", "forma de atención", "n"], ["015676", "Escolarizada ñ", "1.5"], ["000001", "", "NA"], ["000002", f'"a{separator}""b"""', "3"]]
    path = put("t.csv", "\r\n".join(separator.join(r) for r in lines).encode(encoding))
    df = sources.load_any(spark, path, order_col="seq").orderBy("seq").drop("seq")
    assert df.columns == ["CODLOCAL", "forma de atención", "n"]
    assert [tuple(r) for r in df.collect()] == [
        ("015676", "Escolarizada ñ", "1.5"), ("000001", None, None), ("000002", f'a{separator}"b"', "3"),
    ]
    typed = sources.load_any(spark, path, schema=StructType.fromDDL("n double, CODLOCAL string"))
    assert rows(typed) == [(None, "000001"), (1.5, "015676"), (3.0, "000002")]


def test_late_invalid_byte_changes_the_whole_file(spark, put):
    path = put("late.csv", b"a,b\n" + b"x,1\n" * 5000 + "ñ,2\n".encode("latin-1"))
    assert rows(sources.load_any(spark, path).where("b = '2'")) == [("ñ", "2")]
    assert [r.encoding for r in sources.file_encodings(spark, path).collect()] == ["ISO-8859-1"]


def test_single_column_and_quoted_line_breaks(spark, put):
    assert rows(sources.load_any(spark, put("one.csv", b"solo\n1\n2\n"))) == [("1",), ("2",)]
    path = put("multi.csv", b'a,b\n"x\ny",1\n')
    for df in (sources.read_delimited(spark, path), sources.load_any(spark, path), sources.read_delimited(spark, path, multi_line=True)):
        assert rows(df) == [("x\ny", "1")]


def test_encoding_of_a_path_with_odd_characters(spark, put):
    path = put("a b+c%20/x y.csv", "n,v\ncañón,1\n".encode("latin-1"))
    assert rows(sources.load_any(spark, path)) == [("cañón", "1")]


def test_files_with_different_headers_are_combined(spark, put):
    for kind, make in (
        ("csv", lambda *t: "".join(",".join(r) + "\n" for r in t).encode()),
        ("zip", lambda *t: zip_bytes({"t.csv": "".join(",".join(r) + "\n" for r in t)})),
        ("xlsx", lambda *t: xlsx_bytes([list(r) for r in t])),
    ):
        put(f"mix-{kind}/a.{kind}", make(["n", "v"], ["1", "2"]))
        path = put(f"mix-{kind}/b.{kind}", make(["n", "v", "w"], ["3", "4", "5"]))
        df = sources.load_any(spark, path.rsplit("/", 1)[0])
        assert rows(df.select("n", "v", "w")) == [("1", "2", None), ("3", "4", "5")], kind
    put("mix-dbf/a.dbf", dbf_bytes(FIELDS[:1], [(False, ["1"])]))
    path = put("mix-dbf/b.dbf", dbf_bytes(FIELDS[:2], [(False, ["2", "x"])]))
    df = sources.load_any(spark, path.rsplit("/", 1)[0], order_col="seq")
    assert rows(df.select("CODLOCAL", "NOMBRE")) == [("1", None), ("2", "x")]
    assert [r.CODLOCAL for r in df.orderBy("seq").collect()] == ["1", "2"]


def test_dbf_is_recognised_by_its_bytes(spark, put):
    assert [r.kind for r in sources.recognise(spark, put("noext", dbf_bytes(FIELDS, RECORDS))).collect()] == ["dbf"]
    assert [r.kind for r in sources.recognise(spark, put("text.dbf", b"a,b\n1,2\n")).collect()] == ["text"]


def test_xlsx_truth_values_and_dates(spark, put):
    cells = xlsx_bytes([["b", "d", "t", "n"], [1, 45322, 45322.5, 45322]], styles={(1, 1): 1, (1, 2): 2}, kinds={(1, 0): "b"})
    assert rows(sources.read_xlsx(spark, put("typed.xlsx", cells))) == [("true", "2024-01-31", "2024-01-31 12:00:00", "45322")]

def test_mixed_folder(spark, put):
    put("m/a.csv", b"k,v\n1,a\n")
    put("m/b.csv", "k;v\n2;ñ\n".encode("latin-1"))
    put("m/c.zip", zip_bytes({"c.csv": "k,v\n3,c\n"}))
    path = put("m/d.xlsx", xlsx_bytes([["k", "v"], [4, "d"]]))
    folder = path.rsplit("/", 1)[0]
    assert rows(sources.load_any(spark, folder)) == [("1", "a"), ("2", "ñ"), ("3", "c"), ("4", "d")]
    kinds = {r.path.rsplit("/", 1)[1]: r.kind for r in sources.recognise(spark, folder).collect()}
    assert kinds == {"a.csv": "text", "b.csv": "text", "c.zip": "zip-csv", "d.xlsx": "xlsx"}
    with pytest.raises(ValueError, match="one kind"):
        sources.load_any(spark, folder, order_col="seq")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", ñ', None), (2, None, 2.5)], "i int, s string, x double")
    sources.write_csv(df, str(tmp_path / "csv"))
    back = sources.load_any(spark, str(tmp_path / "csv"), schema=df.schema)
    assert rows(back) == rows(df)
    sources.write_parquet(df, str(tmp_path / "pq"), partition_by=["i"])
    assert rows(spark.read.parquet(str(tmp_path / "pq")).select("i", "s", "x")) == rows(df)


def test_file_order_across_parts(spark, tmp_path):
    spark.range(0, 3000, 1, 6).selectExpr("id", "string(id % 7) k").write.option("header", True).csv(str(tmp_path / "parts"))
    df = sources.load_any(spark, str(tmp_path / "parts"), order_col="seq")
    ids = [int(r.id) for r in df.orderBy("seq").collect()]
    assert ids == list(range(3000))


def test_dbf_filters_are_pushed(spark, put):
    fields = [("K", "N", 8, 0), ("X", "N", 8, 2), ("S", "C", 6, 0), ("D", "D", 8, 0), ("T", "L", 1, 0), ("M", "M", 10, 0)]
    records = [(i % 11 == 0, [str(i) if i % 7 else "", f"{i / 4:.2f}", "ab"[i % 2] * (i % 4), f"202401{1 + i % 28:02d}", "TF?"[i % 3], ""]) for i in range(300)]
    put("f/a.dbf", dbf_bytes(fields, records[:200]))
    path = put("f/b.dbf", dbf_bytes(fields, records[200:])).rsplit("/", 1)[0]
    df = sources.read_dbf(spark, path, order_col="seq", records_per_task=64)
    whole = df.cache()
    tests = [
        "K = 40", "K > 250 and X <= 70.25", "S in ('b', 'aa')", "K is null", "K is not null and S like 'a%'", "D >= date'2024-01-20'",
        "T", "not T", "T is null", "K in (1, 2, 299) or X = 3.5", "length(S) = 2 and K < 100", "K <=> null", "M is null and K = 5", "seq > 100 and K > 20",
    ]
    wanted = [rows(whole.where(test)) for test in tests]
    whole.unpersist()
    for test, found in zip(tests, wanted):
        assert rows(sources.read_dbf(spark, path, order_col="seq", records_per_task=64).where(test)) == found, test
    plan = lambda test: sources.read_dbf(spark, path).where(test)._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan("K > 250 and S in ('b', 'aa')").replace("RuntimeFilters", "")
    assert "Filter" in plan("length(S) = 2").replace("RuntimeFilters", "")


def test_dbf_without_pushed_filters(spark, put):
    """Spark's default is not to push filters into Python sources."""
    path = put("plain.dbf", dbf_bytes(FIELDS, RECORDS))
    setting = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        df = sources.read_dbf(spark, path, order_col="seq").orderBy("seq")
        assert [tuple(r)[:-1] for r in df.collect()] == TABLE
        assert rows(sources.load_any(spark, path).where("TALUM > 7 and CODLOCAL in ('015676', '0041')")) == TABLE[:1]
    finally:
        spark.conf.set(setting, before)


def test_check_files_grow_in_number_not_in_size(spark, monkeypatch):
    from checks import files

    monkeypatch.setattr(files, "FILE_ROWS", 50)
    df = spark.range(1000).selectExpr("id", "concat('name ', id) as name")
    folder = files.write_as(df, "x", ".xlsx", lambda rows: xlsx_bytes([["id", "name"], *rows.values.tolist()]))
    found = sources.load_any(spark, folder)
    assert rows(found) == rows(df.selectExpr("string(id)", "name"))
    assert sources.recognise(spark, folder).count() == 20


def test_workbook_of_many_texts_in_linear_time():
    import time

    begun = time.process_time()
    xlsx_bytes([["name"], *([f"name {i}"] for i in range(40_000))])
    assert time.process_time() - begun < 10


def test_dbf_values_that_are_missing_are_written_blank(spark, put):
    from checks.files import texts

    rows_in = [["015676", 3.0], [None, float("nan")]]
    path = put("blank.dbf", dbf_bytes([("K", "C", 8, 0), ("N", "N", 4, 0)], [(False, texts(r)) for r in rows_in]))
    assert rows(sources.read_dbf(spark, path)) == [("", None), ("015676", 3)]
