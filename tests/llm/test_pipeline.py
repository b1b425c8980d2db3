import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from campusgrid.llm.queries import ORACLE, QUERIES
from checks.compare import compare
from helpers import documents, groups, words
from test_simhash import fingerprint
from test_toxicity import corpus

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Documents with every awkward case beside toxic and clean ones, and labels of some."""
    path = tmp_path_factory.mktemp("tables")
    docs, labels = corpus(300)
    rows = [d[:5] for d in docs] + [(i if i is None else i + 10_000, *rest) for i, *rest in (d[:5] for d in documents())]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    pq.write_table(pa.table({n: [r[k] for r in rows] for k, n in enumerate(names)}), path / "documents.parquet")
    pq.write_table(pa.table({n: [x[k] for x in labels[:200]] for k, n in enumerate(["doc_id", "quality", "toxic"])}), path / "labels.parquet")
    return str(path), rows


def one_of_each_group(rows):
    """Plain Python: groups of fingerprints linked at two bits or fewer, the smallest id of each."""
    prints = [(r, fingerprint(r.text)) for r in rows]
    node = {}
    for r, p in prints:
        if r.doc_id is not None:
            node[p] = min(node.get(p, r.doc_id), r.doc_id)
    links = [(node[p], node[q]) for p in node for q in node if p < q and bin(p ^ q).count("1") <= 2]
    top = groups(links, set(node.values()))
    best = {}
    for r, p in prints:
        known = top[node[p]] if p in node else None
        if known is None or r.doc_id == known:
            best.setdefault(("id", known) if known is not None else ("print", p), []).append(r)
    out = []
    for (kind, _), found in best.items():
        texts = {r.text for r in found}
        assert len(texts) == 1 or kind == "id"
        out.append(found[0])
    return out


def test_near_copies_with_clashing_names(spark):
    rows = [(1, "a b c d", "x", 1), (2, "a b c d", "y", 2), (2, "A B c d", "y", 3), (None, "q r s", "z", 4), (None, "q r s", "z", 4), (7, None, "", 5), (8, "", "", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, row_key bigint")
    found = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [rows[0], rows[3], rows[5]]))


def test_run_leaves_only_the_last_table(spark, folder):
    from campusgrid.llm import shelf

    before = shelf.tables()
    assert corpus_pipeline.run(spark, folder[0]).count() > 0
    assert len(shelf.tables() - before) == 1


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{path}/{name}-{os.getpid()}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = docs.collect()
        assert name == "sentencepiece" or docs.columns == columns
    toxic = {i for i in range(300) if i % 7 == 0}
    left = {r.doc_id for r in kept["toxicity"]}
    assert len(left & toxic) <= 1 and len(set(range(300)) - toxic - left) <= 3
    assert sorted(map(str, kept["simhash_near_dedup"])) == sorted(map(str, one_of_each_group(kept["toxicity"])))
    by_id = {r.doc_id: r for r in kept["substring_dedup"]}
    before = {r.doc_id: r for r in kept["simhash_near_dedup"]}
    assert by_id.keys() == before.keys() and len(words(by_id[10025].text)) < len(words(before[10025].text))
    assert by_id[10017].text == before[10017].text
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept["substring_dedup"])
    assert kept["mixing"] and all(words(r.text) for r in kept["mixing"])
    assert len(kept["sentencepiece"]) == len(kept["mixing"]) and all(r.n_pieces for r in kept["sentencepiece"])


def test_empty_table(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "labels"):
        table = pq.read_table(f"{path}/{name}.parquet")
        pq.write_table(table.slice(0, 0), tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", QUERIES)
def test_queries(spark, name):
    """Every query on the smallest tables; against its SQL where there is one."""
    assert compare(spark, SMALL, QUERIES[name], ORACLE.get(name)) == ""
