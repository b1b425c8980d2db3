import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campusgrid.llm import context_mixing as cm
from campusgrid.llm.words import find_words
from helpers import SCHEMA, documents, words

_LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*words((text or "").translate(_LOWER)), None]


@pytest.mark.parametrize("parts", [1, 4])
def test_counts_against_plain_python(spark, parts):
    rows = documents()
    held = lambda i: i is not None and i % 3 == 0
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = cm.score_texts(df, F.col("doc_id") % 3 == 0).collect()
    count = Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]))
    n, v = sum(count.values()), len(count)
    want = Counter(
        (r[0], held(r[0]), len(tokens(r[1])), sum(count[t] > 0 for t in tokens(r[1])), n,
         round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(r[1])), 6)) for r in rows
    )
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in found)


def test_small_vocabulary_gives_the_same_counts(spark, monkeypatch):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    whole = cm.score_texts(df, F.lit(False)).groupBy().agg(F.round(F.sum("base_score"), 5), F.sum("n_known")).first()
    monkeypatch.setattr(cm, "VOCABULARY", 8)
    assert cm.score_texts(df, F.lit(False)).groupBy().agg(F.round(F.sum("base_score"), 5), F.sum("n_known")).first() == whole


def test_held_out_texts_are_predicted_better_than_by_counts(spark):
    r = random.Random(3)
    follow = {w: r.sample(range(300), 3) for w in range(300)}
    docs = []
    for i in range(400):
        w, out = r.randrange(300), []
        for _ in range(60):
            out.append("w%d" % w)
            w = r.choice(follow[w])
        docs.append((i, " ".join(out)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = cm.score_texts(df, F.col("doc_id") % 5 == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.6 * got[1]


def test_probabilities_add_up():
    """Over all one-word texts of a closed alphabet the word part of the code is a distribution."""
    names = ["a", "b", "c", "dd"]
    hashes = find_words(pa.array([" ".join(names)])).hashes()
    coder = cm.Coder(np.append(hashes, np.uint64(cm.END)), np.array([9, 5, 3, 1, 4]), 30, np.zeros(257))
    plain = np.ones((2, coder.nodes))
    tables = np.zeros((3, cm.SLOTS, 2), dtype=np.float32)
    texts = [*names, "zz", ""]
    place, node, bit, unit, contexts, shares, *_ = coder.decisions(find_words(pa.array(texts)))
    inputs, gate = cm._predictions(coder, plain, tables, node, unit, contexts)
    first_token = []
    for i in range(len(texts)):
        size = np.diff(coder.word.first)[coder.symbols(np.append(find_words(pa.array([texts[i]])).hashes(), np.uint64(cm.END)))[0]]
        z = (inputs[:, place[i] : place[i] + size].T * np.array(cm.START_WEIGHTS)).sum(axis=1)
        signed = np.where(bit[place[i] : place[i] + size] > 0, z, -z)
        first_token.append(math.exp(-np.logaddexp(0, -signed).sum()))
    assert abs(sum(first_token) - 1) < 1e-4


def test_tree_paths_are_a_prefix_code():
    weights = np.array([50, 20, 10, 5, 5, 5, 3, 1, 1], dtype=float)
    for depth in (None, 2, 4):
        tree = cm.build_tree(weights, depth)
        lengths = np.diff(tree.first)
        total = sum(10**rest / 2.0**n for rest, n in zip(tree.rest, lengths))
        assert abs(total - 1) < 1e-9 and (depth is None or lengths.max() <= depth)


def test_no_rows_and_nothing_to_learn_from(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    assert cm.score_texts(df.limit(0), F.lit(False)).collect() == []
    found = cm.score_texts(df, F.lit(True)).collect()
    assert len(found) == df.count() and all(r.base_score == 0 and r.n_known == 0 and r.score < 0 for r in found)


def plain_scores(rows, held):
    """The whole model one decision at a time: counts in dictionaries, mixing by loops. Paths and slots are the coder's."""
    one = lambda text: find_words(pa.array([text or ""]), lower=True)
    training = [r[1] for r in rows if not held(r[0])]
    hashes = np.concatenate([cm.token_hashes(one(t))[0] for t in training])
    found, counts = np.unique(hashes, return_counts=True)
    order = np.lexsort((found.view(np.int64), -counts))
    letters = np.zeros(257)
    for t in training:
        w = words((t or "").translate(_LOWER))
        letters[256] += len(w)
        for b in "".join(w).encode():
            letters[b] += 1
    coder = cm.Coder(found[order], counts[order], int(counts.sum()), letters)

    def steps(text):
        _, node, bit, unit, contexts, shares, *_ = coder.decisions(one(text))
        slots = [cm._slots(coder.salt[node], c[unit]).tolist() for c in contexts]
        return list(zip(node.tolist(), bit.tolist(), *slots)), float(shares[0])

    seen = [Counter() for _ in range(4)]
    for t in training:
        for step in steps(t)[0]:
            for k, key in enumerate((step[0], *step[2:])):
                seen[k][key, step[1]] += 1
    out = []
    for r in rows:
        taken, score = steps(r[1])
        weights, pending = {}, {}
        for n, step in enumerate(taken):
            if n % cm.BLOCK == 0:
                for spot, move in pending.items():
                    weights[spot] = [w + m for w, m in zip(weights.get(spot, cm.START_WEIGHTS), move)]
                pending = {}
            zero, once = (seen[0][step[0], b] + 0.5 for b in (0, 1))
            p = once / (zero + once)
            x, gate = [math.log(once / zero)], int(step[0] >= coder.word.count)
            for k, slot in enumerate(step[2:], 1):
                both = seen[k][slot, 0], seen[k][slot, 1]
                p1, p0 = both[1] + 4 * p, both[0] + 4 * (1 - p)
                x.append(math.log(p1 / p0))
                p = p1 / (p1 + p0)
                if k > 1:
                    gate = gate * 4 + sum(sum(both) > limit for limit in (0.5, 7.5, 63.5))
            z = sum(w * v for w, v in zip(weights.get(gate, cm.START_WEIGHTS), x))
            odds = math.exp(min(max(-z if step[1] else z, -13), 13))
            score -= math.log10(1 + odds)
            error = odds / (1 + odds) * (1 if step[1] else -1)
            pending[gate] = [a + 0.02 * error * v for a, v in zip(pending.get(gate, [0.0] * 4), x)]
        out.append(score)
    return out


def test_scores_against_one_decision_at_a_time(spark):
    """Several blocks a text, words outside the training texts, and slots that several contexts share."""
    rows = [r for r in documents() if r[0] not in (17, 40, 41)]
    held = lambda i: i is not None and i % 3 == 0
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = sorted((str(r.id), r.score) for r in cm.score_texts(df, F.col("doc_id") % 3 == 0).collect())
    wanted = sorted((str(r[0]), s) for r, s in zip(rows, plain_scores(rows, held)))
    assert [i for i, _ in found] == [i for i, _ in wanted]
    assert np.allclose([s for _, s in found], [s for _, s in wanted], rtol=2e-5, atol=2e-3)


def test_the_query_predicts_whole_words(spark, tmp_path):
    """No share of a word's code is left outside the mixing, however many words there are."""
    from campusgrid.llm.queries import op4_context_mixing

    r = random.Random(5)
    docs = [(i, " ".join("w%d" % int(r.paretovariate(0.5) % 3000) for _ in range(100))) for i in range(60)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {row.doc_id: row.score for row in op4_context_mixing(spark, str(tmp_path)).collect()}
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    whole = cm.score_texts(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, tree_depth=None).collect()
    assert len(got) == 60 and all(abs(got[row.id] - row.score) < 1e-3 for row in whole)


def test_counts_of_paths_and_contexts_against_single_decisions():
    texts = pa.array([r[1] for r in documents()])
    found, counts = np.unique(cm.token_hashes(find_words(texts, lower=True))[0], return_counts=True)
    often = np.argsort(-counts, kind="stable")[:40]  # other words are spelled
    coder = cm.Coder(found[often], counts[often], int(counts.sum()), np.ones(257))
    _, node, bit, unit, contexts, *_, units = coder.decisions(find_words(texts, lower=True))
    plain = coder.plain_counts(np.bincount(units, minlength=len(coder.path_size)))
    seen = Counter(zip(node.tolist(), bit.tolist()))
    assert plain.sum() == len(node) and all(plain[b, n] == c for (n, b), c in seen.items())
    tables = np.zeros((3, 2 * cm.SLOTS), dtype=np.uint32)
    cm._tally(coder, node, bit, unit, contexts, tables)
    for table, context in zip(tables, contexts):
        slots = Counter((cm._slots(coder.salt[node], context[unit]) * 2 + bit).tolist())
        assert table.sum() == len(node) and all(table[s] == c for s, c in slots.items())


def test_batches_are_alike_in_size():
    """No small rest, which would cost as much besides its rows as a whole batch."""
    from campusgrid.llm.words import small_batches

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 210)], names=["text"])
    sizes = [b.num_rows for b in small_batches([batch], "text", 1000)]
    assert sum(sizes) == 210 and len(sizes) == 3 and min(sizes) == 70
    assert [b.num_rows for b in small_batches([batch], "text", 5)] == [1] * 210


def test_one_sided_counts_leave_something_to_the_other_side():
    """Ten million decisions one way: a share of 1 in single precision must not make the other bit impossible."""
    words_ = find_words(pa.array(["a b a zz"]))
    coder = cm.Coder(np.sort(words_.hashes())[:1], np.array([3]), 10, np.ones(257))
    place, node, bit, unit, contexts, *_ = coder.decisions(words_)
    plain, tables = np.zeros((2, coder.nodes)), np.zeros((3, cm.SLOTS, 2), dtype=np.float32)
    plain[1], tables[:, :, 1] = 1e7, 1e7
    inputs, gate = cm._predictions(coder, plain, tables, node, unit, contexts)
    assert np.isfinite(inputs).all() and np.isfinite(cm._mix_online(place, bit, inputs, gate, 0.02)).all()


def test_decisions_are_mixed_in_the_order_of_their_steps():
    """Texts of unequal length: every decision has one place, the first blocks of all texts lie side by side."""
    first = np.array([0, 5, 5, 300, 430, 1200])
    steps = cm._steps(first)
    assert sorted(steps.source.tolist()) == list(range(1200)) and steps.ends[0] == 0 and steps.ends[-1] == 1200
    for number, (low, high) in enumerate(zip(steps.ends[:-1], steps.ends[1:])):
        text = np.searchsorted(first, steps.source[low:high], side="right") - 1
        assert (steps.order[steps.spot[low:high] // cm._GATES] == text).all()
        assert ((steps.source[low:high] - first[text]) // cm.BLOCK == number).all()
    r = np.random.default_rng(3)
    bit, gate = r.integers(0, 2, 1200).astype(np.uint8), r.integers(0, 32, 1200).astype(np.uint8)
    inputs = r.normal(0, 2, (4, 1200)).astype(np.float32)
    kept = inputs.copy()
    found, wanted = cm._mix_online(first, bit, inputs, gate, 0.02), []
    assert (inputs == kept).all()
    for low, high in zip(first[:-1], first[1:]):
        weights, score = {g: np.array(cm.START_WEIGHTS) for g in range(32)}, 0.0
        for at in range(low, high, cm.BLOCK):
            moves = {}
            for i in range(at, min(high, at + cm.BLOCK)):
                sign = 1 - 2 * int(bit[i])
                odds = np.exp(np.clip(sign * weights[gate[i]] @ kept[:, i].astype(float), -13, 13))
                score -= np.log10(1 + odds)
                moves[gate[i]] = moves.get(gate[i], 0) + 0.02 * sign * odds / (1 + odds) * kept[:, i]
            for g, move in moves.items():
                weights[g] = weights[g] - move
        wanted.append(score)
    assert np.allclose(found, wanted, rtol=1e-4, atol=1e-3)


@pytest.mark.parametrize("counts", [[], [0], [1, 255, 256, 2**33, 2**62, 0, 7]])
def test_counts_are_packed_without_loss(counts):
    assert cm._unpacked(cm._packed(np.array(counts, dtype=np.int64)), len(counts)).tolist() == counts
