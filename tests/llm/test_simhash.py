from collections import Counter

import numpy as np
import xxhash
import pytest

from campusgrid.llm.components import components
from campusgrid.llm.simhash import _links, _settle, print_links, simhash_groups
from helpers import SCHEMA, documents, groups, words

_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    w = words((text or "").translate(_LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_groups_against_all_pairs(spark, parts):
    rows = documents()
    prints = [(r[0], fingerprint(r[1])) for r in rows]
    known = [p for p in prints if p[0] is not None]
    links = [(a, b) for a, x in known for b, y in known if a < b and bin(x ^ y).count("1") <= 2]
    group = groups(links, {i for i, _ in known})
    by_print = {p: group[i] for i, p in known}
    want = Counter((i, p, by_print.get(p)) for i, p in prints)
    found = simhash_groups(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert Counter((r.id, int.from_bytes(r.print, "little"), r.component_id) for r in found) == want
    assert simhash_groups(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("tile", [3, 2048])
@pytest.mark.parametrize("distance,blocks", [(2, 4), (3, 5), (0, 1)])
def test_links_connect_what_all_pairs_connect(spark, tile, distance, blocks):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(base.tolist())
    for x in base[:12].tolist():  # chains and clusters around a few
        for _ in range(20):
            for bit in r.integers(0, 64, r.integers(1, 4)):
                x ^= 1 << int(bit)
            prints.add(x)
    prints = sorted(prints)
    want = groups([(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= distance], range(len(prints)))
    df = spark.createDataFrame([(i, bytearray(p.to_bytes(8, "little"))) for i, p in enumerate(prints)], "node bigint, print binary")
    links = [(e.a, e.b) for e in print_links(df, 64, distance, blocks, blocks - distance, tile).collect()]
    assert all(bin(prints[a] ^ prints[b]).count("1") <= 64 for a, b in links)
    assert groups(links, range(len(prints))) == want


def test_large_group_is_swept_exactly():
    r = np.random.default_rng(5)
    prints = np.unique(np.cumsum(1 << r.integers(0, 9, 400, dtype=np.uint64), dtype=np.uint64))[:, None]
    a, b = _links(np.arange(len(prints)), prints, np.array([0, len(prints)]), 1)
    i, j = np.triu_indices(len(prints), 1)
    near = np.bitwise_count(prints[i, 0] ^ prints[j, 0]) <= 1
    assert (_settle(len(prints), a, b) == _settle(len(prints), i[near], j[near])).all()


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    r = np.random.default_rng(1)
    edges = {
        "path": [(i, i + 1) for i in range(60)] + [(100 - i, 101 - i) for i in range(10)],
        "star": [(50, i) for i in range(40)] + [(7, 7)],
        "random": [tuple(map(int, e)) for e in r.integers(0, 200, (150, 2))] + [(1, None), (None, None)],
        "none": [],
    }[shape]
    real = [(a, b) for a, b in edges if a is not None and b is not None]
    want = groups(real, {x for e in real for x in e})
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {k: v for k, v in want.items() if k != v}
    assert len(found) == len({r.node for r in found})
