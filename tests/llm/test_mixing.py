from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from campusgrid.llm.mixing import _order, deal, mix_sources
from helpers import SCHEMA, documents, words

WEIGHTS = {"domain": {"a": 3, "b": 1}, "lang": {"en": 2}, "source": {"src1": 5}}


def domain():
    return F.when(F.col("source") == "src0", "a").when(F.col("source").isNotNull(), "b")


def test_deal():
    assert deal(10, [1, 1], [100, 100]).tolist() == [5, 5]
    assert deal(10, [1, 1, 2], [1, 100, 100]).tolist() == [1, 3, 6]
    assert deal(11, [1, 1], [5, 100]).tolist() == [5, 6]
    assert deal(1000, [1, 2], [5, 7]).tolist() == [5, 7]
    assert deal(10, [0, 1], [9, 4]).tolist() == [6, 4]
    assert deal(7, [1, 1, 1], [9, 9, 9]).tolist() == [3, 2, 2]
    assert deal(0, [1], [5]).tolist() == [0] and deal(5, [], []).tolist() == []


def plan(rows, share, epochs):
    """Budgets from the top down, as the tree says."""
    tokens = defaultdict(int)
    for i, t, lang, source, *_ in rows:
        if words(t):
            name = {"src0": "a", None: ""}.get(source, "b")
            tokens[name, lang or "", source or ""] += len(words(t))
    out = {(): int(sum(tokens.values()) * share)}
    for depth, level in enumerate(("domain", "lang", "source")):
        for parent in {k[:depth] for k in tokens}:
            children = sorted({k[: depth + 1] for k in tokens if k[:depth] == parent})
            caps = [sum(v for k, v in tokens.items() if k[: depth + 1] == c) * epochs for c in children]
            given = deal(out[parent], np.array([WEIGHTS[level].get(c[-1], 1.0) for c in children]), np.array(caps))
            out.update(zip(children, given.tolist()))
    return {k: out[k] for k in tokens}, tokens


@pytest.mark.parametrize("share,epochs,bucket_rows", [(0.8, 2, 4096), (0.3, 1, 3), (1.7, 2, 2), (9.0, 3, 8)])
def test_budgets_and_prefixes(spark, share, epochs, bucket_rows):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    mixed = mix_sources(df, domain(), WEIGHTS, share, epochs, bucket_rows=bucket_rows)
    found = mixed.select("row.*", "domain", "epoch", "n_tokens", "take_tokens").collect()
    budgets, tokens = plan(rows, share, epochs)
    taken, copies = Counter(), Counter((r[0], r[1], r[2], r[3]) for r in rows)
    seen = defaultdict(set)
    for r in found:
        leaf = (r.domain, r.lang or "", r.source or "")
        taken[leaf] += r.take_tokens
        assert r.n_tokens == len(words(r.text)) and 0 < r.take_tokens <= r.n_tokens
        seen[r.doc_id, r.text, r.lang, r.source].add(r.epoch)
    for leaf, budget in budgets.items():
        assert budget - 300 * max(copies.values()) <= taken[leaf] <= budget if budget % tokens[leaf] else taken[leaf] == budget
        cut = [r for r in found if (r.domain, r.lang or "", r.source or "") == leaf and r.take_tokens < r.n_tokens]
        assert len({(r.doc_id, r.text) for r in cut}) <= 1
        if not any(n > 1 for k, n in copies.items() if (k[2] or "", k[3] or "") == leaf[1:]):
            assert taken[leaf] == budget
    assert all(sorted(e) == list(range(len(e))) for e in seen.values())


def test_seed_and_partitioning(spark):
    df = spark.createDataFrame([(i, "a b c d", "en", "src0", 7, "") for i in range(200)], SCHEMA)
    pick = lambda d, seed: {(r.row.doc_id, r.epoch, r.take_tokens) for r in mix_sources(d, domain(), WEIGHTS, 0.31, 2, seed, bucket_rows=16).collect()}
    one = pick(df, 1)
    assert sum(t for _, _, t in one) == int(800 * 0.31)
    assert pick(df.repartition(7), 1) == one and pick(df, 2) != one
    assert mix_sources(df.limit(0), domain()).collect() == []


@pytest.mark.parametrize("share,epochs,bucket_rows", [(0.8, 2, 4096), (0.35, 1, 4), (1.6, 3, 2)])
def test_chosen_rows_are_the_prefix_of_each_leaf(spark, share, epochs, bucket_rows):
    """Plain Python: every leaf in the order of its seeded hash, whole epochs first, then rows until the budget ends."""
    texts = [(i, " ".join(["w"] * (1 + i * 7 % 23)), ["en", "de"][i % 2], ["src0", "src1", "src2"][i % 3], 0, "") for i in range(240)]
    df = spark.createDataFrame(texts, SCHEMA).repartition(3)
    budgets, tokens = plan(texts, share, epochs)
    key = F.xxhash64("doc_id", "text")
    places = {(r.doc_id, e): (r[f"p{e}"], r.key) for r in df.select("doc_id", key.alias("key"), *[_order(key, F.lit(e).cast("bigint"), 7).alias(f"p{e}") for e in range(epochs + 1)]).collect() for e in range(epochs + 1)}
    wanted = set()
    for leaf, budget in budgets.items():
        rows = [t for t in texts if ({"src0": "a"}.get(t[3], "b"), t[2], t[3]) == leaf]
        whole, rest = divmod(budget, tokens[leaf])
        wanted |= {(t[0], e, len(words(t[1]))) for t in rows for e in range(whole)}
        for t in sorted(rows, key=lambda t: places[t[0], whole]):
            take = min(rest, len(words(t[1])))
            if take:
                wanted.add((t[0], whole, take))
            rest -= take
    mixed = mix_sources(df, domain(), WEIGHTS, share, epochs, 7, bucket_rows=bucket_rows)
    assert {(r.doc_id, r.epoch, r.take_tokens) for r in mixed.select("row.doc_id", "epoch", "take_tokens").collect()} == wanted
