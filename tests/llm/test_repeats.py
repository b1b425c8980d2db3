import pytest
from collections import Counter

from campusgrid.llm.substring_dedup import remove_repeats
from helpers import SCHEMA, documents, words


def brute(rows, window):
    first = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = Counter()
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    return out


@pytest.mark.parametrize("window,seed,parts", [(50, 20, 3), (12, 5, 1), (6, 6, 4)])
def test_repeats_against_all_windows(spark, window, seed, parts):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = remove_repeats(df, window=window, seed=seed).select("row.doc_id", "row.row", "n_words", "n_removed", "kept_text")
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect())
    assert got == brute([(r[0], r[1]) for r in rows], window)
    assert any(k[2] for k in got)


def test_texts_that_lose_nothing_may_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, " a \n b ", "x"), (2, None, "y")], "doc_id bigint, text string, kept_text string")
    rows = {r.row.doc_id: (r.row.kept_text, r.kept_text) for r in remove_repeats(df, rejoin=False).collect()}
    assert rows == {1: ("x", " a \n b "), 2: ("y", None)}


def test_no_rows(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
