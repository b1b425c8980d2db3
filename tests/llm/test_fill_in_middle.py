"""Fill-in-the-middle against plain Python, and the boundary set against a sorted list."""

import hashlib
import re

import numpy as np
import pytest
from helpers import SCHEMA, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from campusgrid.llm.boundary_set import ARRAY, BITMAP, RUN, BoundarySet
from campusgrid.llm.fill_in_middle import boundary_sets, fill_in_middle, restore

LINE = re.compile("[^\n]*\n|[^\n]+")


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = LINE.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def lined():
    """Documents with many kinds of lines, marks and broken marks."""
    texts = ["\n", "\n\n\n", "a", "a\n", "a\nb", "é\n日本\n𝒳y\r\nend", "x <P> y\nz", "<S>", "a\n<M", ">b\n<P", "S>\n<\n<S\nM>"]
    texts += ["line %d\n" % i * (i % 9) + " tail" for i in range(60)]
    texts += ["x\n" * 9000, "\n" * 70_000, "ab\n" * 40_000 + "é" * 70_000 + "\nz"]
    return documents() + [(1000 + i, t, "en", "s", 0, "x") for i, t in enumerate(texts)]


@pytest.mark.parametrize("options", [{}, {"seed": 3, "rate": 60, "spm": 10}])
def test_equals_plain_python(spark, spread, options):
    docs = lined()
    made = restore(fill_in_middle(spread(spark.createDataFrame(docs, SCHEMA)), **options)).collect()
    ours = sorted(
        (str(r["row"]["doc_id"]), r["row"]["text"] or "", r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"]) for r in made
    )
    wanted = []
    for d in docs:
        n, form, p, m, output = plain(d[0], d[1], **options)
        wanted.append((str(d[0]), d[1] or "", n, form, str(p), str(m), output))
    assert ours == sorted(wanted)
    assert all(r["restored"] == (r["row"]["text"] or "") for r in made)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_stored_sets_serve_other_seeds(spark):
    docs = spark.createDataFrame(lined(), SCHEMA)
    stored = boundary_sets(docs, name="sets")
    for seed in (1, 2):
        a = fill_in_middle(stored, seed=seed, boundaries="sets")
        b = fill_in_middle(docs, seed=seed)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_empty_table_and_clashing_names(spark):
    assert fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, "a\nb\n", "p", "q", "r")], "doc_id bigint, text string, output string, form string, cut string")
    (r,) = fill_in_middle(docs).collect()
    assert (r["row"]["output"], r["row"]["form"], r["row"]["cut"]) == ("p", "q", "r") and r["output"] == plain(1, "a\nb\n")[4]


@pytest.mark.parametrize("marks", [("<P>", "<P>x", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("xy", "yz", "<M>")])
def test_marks_that_overlap(spark, marks):
    with pytest.raises(ValueError, match="overlap"):
        fill_in_middle(spark.createDataFrame([], SCHEMA), marks=marks)


def test_python_sees_a_text_once(spark):
    plan = fill_in_middle(spark.createDataFrame(lined(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2


@pytest.mark.parametrize(
    "values, kinds",
    [
        ([], []),
        ([5], [ARRAY]),
        (range(0, 8000, 2), [ARRAY]),
        (range(0, 20_000, 3), [BITMAP]),
        (range(100, 65_000), [RUN]),
        (range(65_536 * 2), [RUN, RUN]),
        ([1, 65_535, 65_536, 200_000, 2**40], [ARRAY] * 4),
        ([*range(0, 60_000, 5), *range(70_000, 90_000), 150_000], [BITMAP, RUN, ARRAY]),
    ],
)
def test_containers(values, kinds):
    values = list(values)
    for made in (BoundarySet.of(np.array(values, dtype=np.int64)),):
        again = BoundarySet.from_bytes(made.to_bytes())
        assert again.kinds.tolist() == kinds and len(again) == len(values)
        for k in {*range(min(50, len(values))), *range(0, len(values), 997), *range(max(0, len(values) - 50), len(values))}:
            assert again.select(k) == values[k]
        with pytest.raises(IndexError):
            again.select(len(values))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400_000), max_size=300), st.integers(0, 300_000), st.integers(0, 9000))
def test_select_equals_sorted_list(some, start, length):
    values = sorted(some | set(range(start, start + length)))
    made = BoundarySet.from_bytes(BoundarySet.of(np.array(values, dtype=np.int64)).to_bytes())
    assert [made.select(k) for k in range(0, len(values), max(1, len(values) // 40))] == values[:: max(1, len(values) // 40)]
