"""Decontamination against a plain search of every window in every text."""

import random
import re

import pytest
from helpers import SCHEMA, documents

from campusgrid.llm.decontaminate import SuffixAutomaton, decontaminate

RUN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id bigint, text string, row string, made string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(texts, items, window):
    """Per text: words, hit places, ids of the items found."""
    windows = {}
    for item, text in items:
        words = RUN.findall(lowered(text or ""))
        k = min(window, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            windows.setdefault(tuple(words[i : i + k]), set()).add(item)
    out = []
    for text in texts:
        words, hit, found = RUN.findall(lowered(text or "")), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                owners = windows.get(tuple(words[i : i + k]))
                if owners:
                    hit |= set(range(i, i + k))
                    found |= owners
        out.append((len(words), hit, sorted(str(i) for i in found if i is not None)))
    return out


def check(spark, docs, items, window, spread=lambda df: df, **options):
    frame = spread(spark.createDataFrame(docs, SCHEMA))
    found = decontaminate(frame, spark.createDataFrame([(*i, "a", "b") for i in items], ITEMS), window=window, **options).collect()
    ours = sorted(
        (str(r["row"]["doc_id"]), str(r["row"]["text"]), r["n_words"], sorted({p for s in r["spans"] for p in range(*s)}), r["n_hit"], r["items"])
        for r in found
    )
    wanted = plain([d[1] for d in docs], items, window)
    assert ours == sorted((str(d[0]), str(d[1]), n, sorted(hit), len(hit), ids) for d, (n, hit, ids) in zip(docs, wanted))
    return found


def some_items(docs, seed=5):
    r = random.Random(seed)
    texts = [d[1] for d in docs if d[1] and len(d[1].split()) > 30]
    items = [(i, " ".join(r.choice(texts).split()[3 : 3 + r.randint(1, 25)])) for i in range(12)]
    items += [(20, None), (21, ""), (22, "- !"), (23, "one"), (24, "W1-w2 w3"), (24, "w9 w8"), (None, "w5 w6"), (25, items[0][1]), (25, items[0][1])]
    return items + [(26, items[1][1] + " " + items[2][1]), (27, "z z z z z z z z z z z z")]


@pytest.mark.parametrize("window", [1, 3, 10])
def test_equals_plain_search(spark, spread, window):
    docs = documents()
    check(spark, docs, some_items(docs), window, spread)


def test_small_vocabulary(spark):
    """Few words: runs repeat within and between items, and states are split often."""
    r = random.Random(2)
    text = lambda n: " ".join(r.choice("abc") for _ in range(n))
    docs = [(i, text(r.randint(0, 60)), "en", "s", 0, "x") for i in range(60)]
    check(spark, docs, [(i, text(r.randint(1, 14))) for i in range(15)], 6)


def test_several_automata(spark, spread):
    """A benchmark of many shards, items longer than a piece."""
    docs = documents()
    long = [(50 + i, d[1]) for i, d in enumerate(d for d in docs if d[1] and len(d[1].split()) > 200)]
    check(spark, docs, some_items(docs) + long, 5, spread, shard_words=320)


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, "?!")]])
def test_nothing_to_find(spark, items):
    docs = documents()
    found = check(spark, docs, items, 10)
    assert {r["kept_text"] for r in found} == {d[1] for d in docs}
    empty = decontaminate(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a", "", "")], ITEMS))
    assert empty.collect() == []


def test_texts_without_their_spans(spark):
    text = "Keep this. The  Quick-brown fox JUMPS over, the lazy dog! And this\n"
    docs = [(1, text, "en", "s", 0, "x"), (2, "quick brown fox jumps over the", "en", "s", 0, "x"), (3, None, "en", "s", 0, "x")]
    items = spark.createDataFrame([(7, "a quick brown fox jumps over the lazy cat", "", "")], ITEMS)
    found = decontaminate(spark.createDataFrame(docs, SCHEMA), items, window=5, max_coverage=0.6).collect()
    by_id = {r["row"]["doc_id"]: r for r in found}
    assert by_id[1]["kept_text"] == "Keep this. The   dog! And this\n" and by_id[1]["longest"] == 7
    assert (by_id[1]["dropped"], by_id[2]["dropped"], by_id[3]["dropped"]) == (False, True, False)
    assert (by_id[2]["kept_text"], by_id[3]["kept_text"]) == ("", None)


def test_very_long_text(spark):
    r = random.Random(9)
    words = [r.choice(["w%d" % i for i in range(300)]) for _ in range(400_000)]
    items = [(i, " ".join(words[i * 7000 : i * 7000 + 40])) for i in range(50)]
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s", 0, "x")], SCHEMA)
    (found,) = decontaminate(docs, spark.createDataFrame([(*i, "", "") for i in items], ITEMS)).collect()
    assert found["n_hit"] == 50 * 40 and len(found["items"]) == 50 and found["longest"] == 40


def test_automaton_holds_every_run():
    r = random.Random(4)
    items = [[r.randrange(4) for _ in range(r.randint(1, 30))] for _ in range(20)]
    automaton = SuffixAutomaton()
    for i, words in enumerate(items):
        automaton.add(str(i), words)
    runs = {tuple(w[a:b]) for w in items for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
    held, open_states = set(), [((), 0)]
    while open_states:
        run, state = open_states.pop()
        for word, there in automaton.step[state].items():
            held.add(run + (word,))
            open_states.append((run + (word,), there))
    assert held == runs
    assert len(automaton.size) <= 2 * sum(map(len, items)) + 1
