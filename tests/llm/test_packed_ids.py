import io
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from campusgrid.llm import packed_ids
from helpers import SCHEMA, documents

MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_packing_and_random_access(bits):
    r = np.random.default_rng(bits)
    ids = r.integers(0, 2**bits, 5003, dtype=np.uint64).astype(np.uint32)
    assert (packed_ids.unpack(packed_ids.pack(ids, bits), bits, len(ids)) == ids).all()
    first = np.array([0, 0, 7, 4096, 5003])
    data = packed_ids.file_bytes(ids, first, np.array([0, -3, 2**40, 9]), np.array([True, False, False, False]), bits, 100)
    file = packed_ids.PackedFile(io.BytesIO(data))
    assert file.bits == bits and file.docs.tolist() == [0, -3, 2**40, 9] and file.nulls.tolist() == [True, False, False, False]
    for i in range(4):
        assert (file.document(i) == ids[first[i] : first[i + 1]]).all()
    for a, b in r.integers(0, 5004, (40, 2)):
        assert (file.read(int(min(a, b)), int(max(a, b))) == ids[min(a, b) : max(a, b)]).all()
    assert len(data) < 5003 * bits / 8 + 51 * 8 + 4 * 20 + 200


def test_ids_are_the_librarys():
    with open(MODEL, "rb") as f:
        data = f.read()
    library, own = Tokenizer.from_str(data.decode()), packed_ids.TextIds(data)
    r = random.Random(1)
    letters = list("abcZ'sStTé éÀßĲŉſİıΣςσ́ \t\n \u0085  123²½,.!<|>_-日本🙂") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "don't", "İstanbul", "é"]
    for _ in range(1500):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("change", ["none", "case kept", "white space kept"])
def test_other_tokenizers_go_to_the_library(change):
    with open(MODEL, "rb") as f:
        rules = json.load(f)
    if change == "case kept":
        rules["normalizer"] = {"type": "NFC"}
    elif change == "white space kept":
        rules["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    data = json.dumps(rules).encode()
    library, own = Tokenizer.from_str(data.decode()), packed_ids.TextIds(data)
    assert (own.words is None) == (change != "none")
    for text in ("The Quick  Brown fox", "AbC dEf\tG12", "don't STOP é"):
        assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file_ids", [500, 1 << 20])
def test_files_in_order_of_id(spark, file_ids):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    folder = packed_ids.packed_folder(df)
    manifest = packed_ids.write_ids(df, MODEL, 2, folder, file_ids=file_ids)
    found = packed_ids.read_documents(manifest, folder).orderBy("start").collect()
    library, at, want = Tokenizer.from_file(MODEL), 0, []
    for i, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [tuple(r) for r in found] == want
    assert (manifest.count() > 8) == (file_ids == 500)  # eight partitions


def test_small_files_share_a_table_and_a_task(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"some words of row {i}") for i in range(400)], "doc_id bigint, text string")
    folder = packed_ids.packed_folder(df)
    manifest = packed_ids.write_ids(df, MODEL, 2, folder, file_ids=100)
    assert manifest.count() > 8 and len(manifest.inputFiles()) == 1
    found = packed_ids.read_documents(manifest, folder)
    assert found.rdd.getNumPartitions() == 1 and found.count() == 400
    monkeypatch.setattr(packed_ids, "READ_IDS", 1000)
    again = packed_ids.read_documents(manifest, folder)
    assert 1 < again.rdd.getNumPartitions() < manifest.count() and sorted(again.collect()) == sorted(found.collect())


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    folder = packed_ids.packed_folder(df)
    assert packed_ids.read_documents(packed_ids.write_ids(df, MODEL, 2, folder), folder).collect() == []
