import heapq
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from campusgrid.llm import pieces
from campusgrid.llm.words import mix
from helpers import SCHEMA, documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tables():
    with open(MODEL, "rb") as f:
        return pieces.load_pieces(f.read())


def texts():
    r = random.Random(4)
    letters = list("abcdeth  e\n\t,.é日▁🙂\x00") + ["the ", " and", "ing"]
    odd = ["", None, " ", "▁", "a ▁ b▁▁c", "  two  spaces ", "x" * 500, "word " * 300, "日本語" * 40, " " * 90]
    return odd + ["".join(r.choice(letters) for _ in range(r.randint(1, 80))) for _ in range(200)]


def test_without_dropout_it_is_the_models_own_segmentation(tables):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = [t for t in texts() if t is None or "▁" not in t]
    values, first = pieces.encode_column(tables, pa.array(some), np.arange(len(some)), 1, 0.0)
    assert [values[a:b].tolist() for a, b in zip(first, first[1:])] == [library.encode(t or "") for t in some]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(tables, dropout):
    some = texts()
    values, first = pieces.encode_column(tables, pa.array(some), np.arange(len(some)), 3, dropout)
    data, offsets = pieces.decode_pieces(tables, values, first)
    assert [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])] == [t or "" for t in some]


def agenda(tables, symbols, key, limit):
    """One unit, a plain heap of candidates."""
    spans = [(i, i + 1, int(s)) for i, s in enumerate(symbols)]
    one = lambda x: np.array([x], dtype=np.int64)
    heap = []

    def offer(a, b):
        order = int(tables.merge_order(one(a[2]), one(b[2]))[0])
        spot = (a[0] << 42) | (a[1] << 21) | b[1]
        hashed = int(mix(np.array([int(key) ^ (spot * 0x9E3779B97F4A7C15 % 2**64)], dtype=np.uint64))[0])
        if order != 2**31 - 1 and hashed >= limit:
            heapq.heappush(heap, (order, a[0], a[1], b[1]))

    for a, b in zip(spans, spans[1:]):
        offer(a, b)
    while heap:
        order, start, middle, end = heapq.heappop(heap)
        at = next((i for i, s in enumerate(spans[:-1]) if s[0] == start and s[1] == middle and spans[i + 1][1] == end), None)
        if at is None:
            continue
        spans[at : at + 2] = [(start, end, int(tables.order[order]))]
        if at:
            offer(spans[at - 1], spans[at])
        if at + 1 < len(spans):
            offer(spans[at], spans[at + 1])
    return [s[2] for s in spans]


@pytest.mark.parametrize("dropout", [0.1, 0.4])
def test_dropout_follows_the_agenda(tables, dropout):
    r = random.Random(6)
    limit = np.uint64(int(dropout * 2.0**64))
    for size in [*range(2, 14), 60, 90]:
        rows = np.array([[tables.char[ord(r.choice("theandring"))] for _ in range(size)] for _ in range(25)], dtype=np.int32)
        key = mix(np.arange(25, dtype=np.uint64) + np.uint64(size * 100))
        want = [agenda(tables, row, k, int(limit)) for row, k in zip(rows, key)]
        assert [pieces._encode_long(tables, row, k, 0, limit).tolist() for row, k in zip(rows, key)] == want
        if size <= pieces._LONG:
            got = {}
            for places, found in pieces._encode_rows(tables, rows.copy(), key, np.zeros(25, dtype=np.int64), limit):
                got.update({int(p): f.tolist() for p, f in zip(places, found)})
            assert [got[i] for i in range(25)] == want


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_long_units_fall_apart_and_follow_the_agenda(tables, dropout):
    """Characters of many kinds without a space: cut where no piece reaches across, each candidate hashed by its place
    in the whole unit."""
    r = random.Random(11)
    letters = "abcdefgthe0123ABCXYZ+/=日本語中文字" + "qxzjkv"
    some = ["".join(r.choice(letters) for _ in range(n)) for n in (60, 200, 400)] + ["".join(r.choice("thering") for _ in range(150))]
    values, first = pieces.encode_column(tables, pa.array(some), np.arange(len(some)), 9, dropout)
    limit = int(dropout * 2.0**64)
    for i, text in enumerate(some):
        want, symbols = [], [tables.space, *[int(tables.char[ord(c)]) for c in text]]
        assert min(symbols) >= 0
        seeded = mix(np.array([i], dtype=np.uint64) ^ np.uint64(19))
        want = agenda(tables, symbols, mix(seeded + np.uint64(0))[0], limit)
        assert values[first[i] : first[i + 1]].tolist() == want


def test_long_units_take_no_longer_than_others(tables):
    r = random.Random(3)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(80_000))
    begun = time.process_time()
    values, _ = pieces.encode_column(tables, pa.array([text]), np.arange(1), 1, 0.1)
    assert time.process_time() - begun < 2.0 and len(values) < 80_000


def test_on_spark(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded = pieces.decode(pieces.encode(df, MODEL, 0.2, seed=5), MODEL)
    found = coded.select("row.doc_id", "row.row", "pieces", "decoded").collect()
    assert Counter((r.doc_id, r.decoded) for r in found) == Counter((r[0], r[1] or "") for r in rows)
    by_seed = {s: {r.row.doc_id: tuple(r.pieces) for r in pieces.encode(df, MODEL, 0.2, seed=s).collect()} for s in (5, 6)}
    assert by_seed[5][17] != by_seed[6][17] and by_seed[5][17] == tuple(next(r.pieces for r in found if r.doc_id == 17))
    assert pieces.decode(pieces.encode(df.limit(0), MODEL), MODEL).collect() == []
