"""Whitening against a plain eigendecomposition of the whole covariance."""

import math

import numpy as np
import pytest

from campusgrid.llm.queries import op11_whitening
from campusgrid.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>, id string, x string"


def plain(vectors, k):
    """n, deviations, whitened columns and explained shares, by numpy on all rows at once."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    return n, deviation, centred @ turn / np.sqrt(values), values / (centred**2).sum() * n


def check(found, ids, vectors, k, near=1e-7):
    n, deviation, whitened, explained = plain(vectors, k)
    rows = {(r["id"], r["component"]): r for r in found.collect()}
    assert len(rows) == len(ids) * k
    for c in range(k):
        ours = np.array([rows[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(ours @ whitened[:, c])
        assert np.abs(ours - sign * whitened[:, c]).max() < near
        assert abs(rows[ids[0], c + 1]["explained"] / explained[c] - 1) < 1e-9
    for i, d in zip(ids, deviation):
        assert (rows[i, 1]["n"], int(rows[i, 1]["deviation"])) == (n, d)
    assert rows[ids[0], 1]["identity_error"] < 1e-9


@pytest.mark.parametrize("decay", [0.0, 0.5, 3.0])
def test_equals_eigendecomposition(spark, spread, decay):
    r = np.random.default_rng(3)
    basis = np.linalg.qr(r.standard_normal((40, 40)))[0]
    v = (r.standard_normal((300, 40)) * (np.arange(1, 41) ** -decay)) @ basis
    rows = [(i, [float(c) for c in row], "other", "x") for i, row in enumerate(v)]
    check(whiten(spread(spark.createDataFrame(rows, SCHEMA)), 8, guard=8), list(range(300)), v, 8, 1e-6)


def test_awkward_rows(spark, spread):
    r = np.random.default_rng(4)
    v = [[float(np.float32(c)) for c in row] for row in r.standard_normal((30, 5))]
    rows = [(i, row, None, None) for i, row in enumerate(v)]
    rows += [(90, None, "", ""), (91, [1.0, None, 0.0, 0.0, 0.0], "", ""), (92, [float("nan")] * 5, "", "")]
    rows += [(93, [float("inf"), 0.0, 0.0, 0.0, 0.0], "", ""), (94, [1e30, 0.0, 0.0, 0.0, 0.0], "", "")]
    rows += [(95, v[0][:2], "", ""), (96, [], "", "")]
    used = v + [v[0][:2] + [0.0] * 3, [0.0] * 5]
    check(whiten(spread(spark.createDataFrame(rows, SCHEMA)), 5), [*range(30), 95, 96], used, 5)


def test_repeated_rows_and_null_ids_count(spark):
    rows = [(1, [0.0, 1.0], "", ""), (1, [0.0, 1.0], "", ""), (None, [1.0, 0.0], "", "")]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 3 and {r["n"] for r in found} == {3} and {r["component"] for r in found} == {1}
    assert sorted(round(abs(r["whitened"]), 9) for r in found) == pytest.approx([0.5**0.5, 0.5**0.5, 2**0.5])


@pytest.mark.parametrize("rows", [[], [(1, None, "", "")], [(1, [], "", "")], [(1, [1.0, 2.0], "", "")] * 3])
def test_nothing_varies(spark, rows):
    assert whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2.0**38), float(i)], "", "") for i in range(4)] + [(9, [0.0, 0.0], "", "")]
    x = [[int(1024 * c) + 100_000 for c in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    wanted = {r[0]: sum((5 * c - s) ** 2 for c, s in zip(v, sums)) for r, v in zip(rows, x)}
    found = whiten(spark.createDataFrame(rows, SCHEMA)).where("component = 1").collect()
    assert {r["id"]: int(r["deviation"]) for r in found} == wanted


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    v = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    found = op11_whitening(spark, folder).withColumnRenamed("vec_id", "id")
    check(found, [r["vec_id"] for r in v], [r["embedding"] for r in v], 8)
