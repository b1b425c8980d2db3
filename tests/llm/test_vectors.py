import numpy as np
import pytest
from pyspark.sql import functions as F

from campusgrid.llm import grid, hash_forest, topk
from campusgrid.llm.hash_forest import candidates, forest_neighbours, hash_strings, planes
from campusgrid.llm.queries import op10_hash_forest
from campusgrid.llm.topk import exact_top_k

SCHEMA = "vec_id bigint, embedding array<float>, id int, shard int"


def vectors(n=600, dims=12, seed=1):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims)).astype(np.float32)
    x[50:80] = x[50]  # equal vectors
    rows = [(i, [float(v) for v in row], 0, 0) for i, row in enumerate(x)]
    rows[10] = (10, None, 0, 0)
    rows[20] = (20, [1.0, None] + [0.0] * (dims - 2), 0, 0)
    rows[30] = (30, [float("nan")] * dims, 0, 0)
    rows[31] = (31, [float("inf")] * dims, 0, 0)
    rows[40] = (40, [0.0] * dims, 0, 0)
    rows[41] = (41, [1.0, 2.0], 0, 0)
    rows[42] = (42, [], 0, 0)
    return rows + [(None, rows[0][1], 0, 0), rows[5], rows[100]]


def usable(rows, zero):
    out = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = np.array(v + [0.0] * (12 - len(v)), dtype=np.float64)
    return out


@pytest.mark.parametrize("rounds", [5, 8192])
@pytest.mark.parametrize("shard,block,lists,scale", [(64, 4, 4, 256.0), (8192, 512, 1, 256.0), (100, 3, 12, 1e8), (100, 5, 3, 0.4)])
def test_top_k_against_all_scores(spark, monkeypatch, shard, block, lists, scale, rounds):
    monkeypatch.setattr(grid, "QUERY_ROWS", rounds)
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {}
    for r in exact_top_k(df, F.col("id") % 50 == 0, 5, scale, lists=lists).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = {i: [int(np.floor(x * scale)) for x in v] for i, v in usable(rows, True).items()}
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        assert found.pop(q) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert not found


@pytest.mark.parametrize("operator", [lambda d, k: exact_top_k(d, F.col("id") >= 0, k), lambda d, k: forest_neighbours(d, F.col("id") >= 0, k)])
def test_few_rows(spark, operator):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, 0), (2, [1.0, 1.0], 0, 0), (3, [3.0, 0.0], 0, 0)], SCHEMA)
    assert len(operator(df, 5).collect()) == 6
    assert operator(df.limit(1), 5).collect() == [] and operator(df.limit(0), 5).collect() == []


@pytest.mark.parametrize("shard", [128, 8192])
def test_forest_recall_and_exact_distances(spark, monkeypatch, shard):
    monkeypatch.setattr(hash_forest, "SHARD_ROWS", shard)
    rows = vectors(1500)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {}
    for r in forest_neighbours(df, F.col("id") % 25 == 0, 10).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    good = usable(rows, False)
    hits = wanted = 0
    for q in (i for i in good if i % 25 == 0):
        best = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)
        got = found.pop(q)
        assert len(got) == 10 and got == sorted(got, key=lambda x: (x[1], x[0]))
        assert all(abs(s - np.sqrt(((good[q] - good[i]) ** 2).sum())) < 1e-12 for i, s in got)
        hits += len({i for i, _ in got} & {i for _, i in best[:10]})
        wanted += 10
    assert not found and hits >= 0.9 * wanted


def test_candidates_are_prefix_ranges():
    """The candidates of a query are those whose prefix agrees as far as the level at which the ascent ended."""
    r = np.random.default_rng(2)
    x, q = r.standard_normal((300, 8)), r.standard_normal((20, 8))
    trees = planes(8, 6, 1)
    strings, orders, asked = [], [], []
    for tree in trees:
        found = hash_strings(x, tree)
        order = np.argsort(found, kind="stable")
        strings.append(found[order])
        orders.append(order)
        asked.append(hash_strings(q, tree))
    table = candidates(strings, orders, asked, 300, 60)
    for i in range(20):
        agree = np.zeros(300, int)
        for tree, a in zip(trees, asked):
            mine = hash_strings(x, tree)
            agree = np.maximum(agree, [64 - int(v).bit_length() for v in (mine ^ a[i])])
        level = max(n for n in range(65) if (agree >= n).sum() >= 60)
        assert (table[i] == (agree >= level)).all()


def test_recall_of_the_registered_query(spark):
    """Against brute force over the whole table."""
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, table = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    found = {}
    for r in op10_hash_forest(spark, folder).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in ids[ids % 100 == 0]:
        far = np.where(ids == q, np.inf, np.sqrt(((table - table[ids == q]) ** 2).sum(axis=1)))
        hits += len(found[q] & set(ids[np.lexsort((ids, far))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(found)


def test_only_results_are_shuffled(spark):
    """Neither the stored vectors nor the forest is dealt out for the queries."""
    df = spark.createDataFrame(vectors(400), SCHEMA)
    kept = grid.usable(df, "vec_id", "embedding", True)
    asked = spark.sparkContext.broadcast((np.array([1]), np.ones((1, 12)), None))
    plan = kept.mapInArrow(topk._scan(asked, 3, 4), topk._FOUND)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == kept._jdf.queryExecution().executedPlan().toString().count("Exchange")
