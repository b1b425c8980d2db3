"""Quoted text cut into ranges at any byte gives the records of the whole text."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from campusgrid.sources.quoted import LineStates, _joined, _lines, file_ranges, read_quoted

from conftest import rows


def text_of(table, line_end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=line_end).writerows(table)
    return out.getvalue()


def random_table(r, lines=12):
    cell = lambda: "".join(r.choice('ab,"\n é') for _ in range(r.randint(0, 6)))
    return [["x", "y", "z"]] + [[cell(), cell(), "v%d" % i] for i in range(lines)]


def cut(raw, size, separator=","):
    """Records of all ranges, each started as its predecessors say."""
    states, inside, out = LineStates(separator), False, []
    for start in range(0, max(len(raw), 1), size):
        stop = min(start + size, len(raw))
        out += _joined(_lines(io.BytesIO(raw), start, stop), inside, states)
        for line, own in _lines(io.BytesIO(raw), start, stop):
            if own:
                inside = not states.closed(line, inside)
    return out


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_any_cut_gives_all_records(line_end):
    r = random.Random(6)
    for _ in range(40):
        table = random_table(r)
        raw = text_of(table, line_end).encode()
        if r.random() < 0.5:
            raw = raw.removesuffix(line_end.encode())
        for size in (1, 2, 3, 7, 20, 64, 10_000):
            found = cut(raw, size)
            assert [next(csv.reader(io.StringIO(f.decode()), strict=True)) for f in found if f] == table


def test_quotes_within_plain_values():
    raw = b'a,5" pipe\nb,"two\nlines" tail\n"x ""y""\n",6"\nc,d\n'
    for size in range(1, len(raw) + 1):
        assert cut(raw, size) == [b'a,5" pipe', b'b,"two\nlines" tail', b'"x ""y""\n",6"', b"c,d"]


def test_open_quote_takes_the_rest():
    raw = b'a,b\n"c,d\ne,f\n'
    for size in range(1, len(raw) + 1):
        assert cut(raw, size) == [b"a,b", b'"c,d\ne,f']


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("size", [16, 100, 1 << 20])
def test_equals_the_whole_file_scan(spark, tmp_path, size):
    r = random.Random(3)
    header = ["x", "y", "z"]
    for i in range(3):
        table = [header] + [[c.strip() or "-" for c in line] for line in random_table(r, 60)[1:]]
        write(tmp_path / f"{i}.csv", text_of(table))
    (tmp_path / "empty.csv").write_text("")
    path = str(tmp_path)
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("x string, y string, z string").csv(path)
    found = read_quoted(spark, path, header, order_col="_at", range_bytes=size)
    assert rows(found.drop("_at")) == rows(whole) and found.count() == 180
    ordered = [r.z for r in found.orderBy("_at").collect()]
    assert ordered == [f"v{i}" for _ in range(3) for i in range(60)]
    if size == 100:
        ranges = file_ranges(spark, path, ",", size)
        assert ranges.groupBy("path").count().agg(F.min("count")).first()[0] >= 5
        assert ranges.where("inside").count() > 0


def test_other_separator_and_encoding(spark, tmp_path):
    text = 'näme;"notiz"\r\n"a;b";"erste\r\nzweite ""ü"""\r\nc;\r\n'
    path = write(tmp_path / "t.csv", text, "latin-1")
    found = read_quoted(spark, path, ["näme", "notiz"], encoding="ISO-8859-1", separator=";", range_bytes=10)
    assert rows(found) == rows(spark.createDataFrame([("a;b", 'erste\r\nzweite "ü"'), ("c", None)], "a string, b string"))


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    table = [["k", "note"]] + [[str(i), f'line one\nline "two" {i}'] for i in range(2000)]
    path = write(tmp_path / "t.csv", text_of(table))
    found = read_quoted(spark, path, ["k", "note"], range_bytes=4096)
    tasks = found.select("k", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 5 and max(t["count"] for t in tasks) < 500
    assert found.where("note = concat('line one\nline \"two\" ', k)").count() == 2000


class Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


def test_a_range_reads_little_beyond_itself():
    raw = b'a,"b\nc"\n' * 200_000
    for start in (0, 1000, 100_000):
        stream = Counted(raw)
        lines = _lines(stream, start, start + 500)
        assert b"\n".join(_joined(lines, False, LineStates(","))) in raw
        assert stream.taken <= 10_000
    stream = Counted(b"x" * 1_000_000 + b"\ny\n")  # ranges inside one long line
    assert list(_lines(stream, 5000, 6000)) == [] and stream.taken <= 10_000


def test_small_ranges_share_tasks(spark, tmp_path):
    table = [["k", "note"]] + [[str(i), f'line one\nline "two" {i}'] for i in range(4000)]
    path = write(tmp_path / "t.csv", text_of(table))
    ranges = file_ranges(spark, path, ",", 64)
    assert ranges.count() > 1000 and ranges.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert read_quoted(spark, path, ["k", "note"], range_bytes=64).where("note = concat('line one\nline \"two\" ', k)").count() == 4000
