"""Token ids in bit-packed files with random access.

A file holds the ids of many documents, each in the fewest bits that hold the vocabulary. Layout (little-endian):

    8 bytes   magic "PACKIDS1"
    6 x u64   bits per id, ids per block, ids, blocks, documents, bytes before the first block
    u64 x blocks + 1       where each block begins, from the file's start; the last is the file's end
    i64 x documents        document ids          u8 x documents   1 for a null id
    u64 x documents + 1    index of each document's first id
    blocks    ids from the lowest bit up; every block begins at a whole byte

A reader fetches the head and only the blocks that a range of ids touches, and unpacks them with numpy.

Documents are dealt out by ranges of their id and sorted within a partition, each of which writes files of at most
``file_ids`` ids (a longer document makes a longer file). A task writes under a name of its own and then renames, so
a task that runs again replaces its files by equal ones. The manifest has one row per file; running sums over it
give every file's first index in the whole corpus."""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campusgrid.llm.shelf import fresh, prepare, save, tidy
from campusgrid.llm.words import small_batches

MAGIC, HEAD = b"PACKIDS1", 8 + 6 * 8
BLOCK_IDS, FILE_IDS, READ_IDS = 4096, 8 << 20, 1 << 20


def pack(ids: np.ndarray, bits: int) -> bytes:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return np.ascontiguousarray(raw[:, : bits // 8]).tobytes()
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    raw, out = np.frombuffer(data, dtype=np.uint8), np.zeros((count, 4), dtype=np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = raw[: count * bits // 8].reshape(count, bits // 8)
    else:
        wide = np.zeros((count, 32), dtype=np.uint8)
        wide[:, :bits] = np.unpackbits(raw, count=count * bits, bitorder="little").reshape(count, bits)
        out = np.packbits(wide, axis=1, bitorder="little")
    return np.ascontiguousarray(out).view("<u4")[:, 0]


def file_bytes(ids: np.ndarray, first: np.ndarray, docs: np.ndarray, nulls: np.ndarray, bits: int, block_ids: int) -> bytes:
    """A whole file: ids of all documents, each document's first index (and the end), the document ids."""
    blocks = [pack(ids[i : i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    begin = HEAD + 8 * (len(blocks) + 1) + 9 * len(docs) + 8 * (len(docs) + 1)
    places = begin + np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = np.array([bits, block_ids, len(ids), len(blocks), len(docs), begin], dtype="<u8")
    parts = [MAGIC, head, places.astype("<u8"), docs.astype("<i8"), nulls.astype("<u1"), first.astype("<u8"), *blocks]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


class PackedFile:
    """Random access to an open binary file (``seek`` and ``read``)."""

    def __init__(self, file: io.IOBase):
        self.file = file
        file.seek(0)
        head = file.read(HEAD)
        if head[:8] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.bits, self.block_ids, self.ids, blocks, docs, begin = np.frombuffer(head[8:], dtype="<u8").astype(int)
        rest = file.read(begin - HEAD)
        cut = np.cumsum([0, 8 * (blocks + 1), 8 * docs, docs, 8 * (docs + 1)])
        part = [rest[a:b] for a, b in zip(cut[:-1], cut[1:])]
        self.places = np.frombuffer(part[0], dtype="<u8").astype(np.int64)
        self.docs, self.nulls = np.frombuffer(part[1], dtype="<i8"), np.frombuffer(part[2], dtype="<u1").astype(bool)
        self.first = np.frombuffer(part[3], dtype="<u8").astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop of the file; only their blocks are read."""
        if stop <= start:
            return np.zeros(0, dtype="<u4")
        low, high = start // self.block_ids, -(-stop // self.block_ids)
        self.file.seek(self.places[low])
        data = self.file.read(int(self.places[high] - self.places[low]))
        out = []
        for b in range(low, high):
            count = min(self.block_ids, self.ids - b * self.block_ids)
            out.append(unpack(data[self.places[b] - self.places[low] : self.places[b + 1] - self.places[low]], self.bits, count))
        return np.concatenate(out)[start - low * self.block_ids : stop - low * self.block_ids]

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.first[number]), int(self.first[number + 1]))


def _visible_bytes() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class WordIds(dict):
    """Ids of words (as bytes of u32) of a tokenizer whose words never reach over white space.

    Words of ASCII and accented Latin letters are split like the tokenizer's own pattern does (letters, single digits,
    other characters) and go to the library's model piece by piece; words with an apostrophe or other characters go
    through the library whole. Both are kept up to a bound; what is not kept is computed again."""

    # Every character of the second range is a letter that composing leaves alone and that has one lower-case form.
    _EASY = re.compile(r"[!-&(-~À-ÖØ-öø-įı-ž]+")
    _PART = re.compile(r"[a-zÀ-ž]+|[0-9]|[^a-z0-9À-ž]+")

    def __init__(self, model: bytes, keep: int = 250_000):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(model.decode())
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.keep, self.parts, self.letters = self.tokenizer.model, keep, {}, _visible_bytes()

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            shown = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            found = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
            if len(self.parts) < self.keep:
                self.parts[part] = found
        return found

    def __missing__(self, word: str) -> bytes:
        if self._EASY.fullmatch(word):
            found = b"".join([self._part(p) for p in self._PART.findall(word.lower())])
        else:
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) < self.keep:
            self[word] = found
        return found


#: The rules that ``WordIds`` and the splitting of ``TextIds`` stand for.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _by_words(model: bytes) -> bool:
    """Whether the tokenizer's rules are those of the short cut; added tokens must be found in the text as it is."""
    rules = json.loads(model)
    same = rules.get("normalizer") == _NORMALIZER and rules.get("pre_tokenizer") == _PRE_TOKENIZER
    return same and not rules["model"].get("dropout") and not any(t["normalized"] for t in rules.get("added_tokens") or [])


class TextIds:
    """Ids of whole texts, as the library gives them with add_special_tokens=False, neither cut nor padded.

    Texts go word by word where the tokenizer's rules allow it, and to the library whole with any other tokenizer."""

    _SPLIT = re.compile(r"[\x20\x09-\x0D]+")

    def __init__(self, model: bytes):
        self.words = WordIds(model) if _by_words(model) else None
        # A special token's text would have to be found across words; such texts go to the library whole.
        plain = Tokenizer.from_str(model.decode())
        self.special = [t.content.lower() for t in plain.get_added_tokens_decoder().values()]
        plain.no_truncation()
        plain.no_padding()
        self.plain = plain

    def __call__(self, text: str) -> bytes:
        lower = text.lower()
        if self.words is None or any(s in lower for s in self.special):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.words.__getitem__, [w for w in self._SPLIT.split(text) if w]))


_loaded: dict[int, TextIds] = {}


def _text_ids(key: int, model) -> TextIds:
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = TextIds(model.value)
    return _loaded[key]


def _writer(key: int, model, folder: str, bits: int, end_id: int, block_ids: int, file_ids: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, partition = _text_ids(key, model), TaskContext.get().partitionId()
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        parts: list[bytes] = []
        sizes: list[int] = []
        docs: list[int | None] = []
        number = total = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            first = np.concatenate([[0], np.cumsum(sizes)])
            nulls = np.array([d is None for d in docs])
            data = file_bytes(ids, first, np.array([d or 0 for d in docs]), nulls, bits, block_ids)
            name = f"part-{partition:06d}-{number:04d}.ids"
            own = f"{root}/_{name}-{uuid.uuid4().hex}"
            with files.open_output_stream(own) as out:
                out.write(data)
            files.move(own, f"{root}/{name}")
            row = pa.RecordBatch.from_pylist([{"name": name, "part": partition, "number": number, "ids": len(ids), "docs": len(docs)}])
            number += 1
            parts.clear(), sizes.clear(), docs.clear()
            return row

        for batch in small_batches(batches, "text"):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                found = coder(text or "") + end
                if docs and total + len(found) // 4 > file_ids:
                    yield flush()
                    total = 0
                parts.append(found)
                sizes.append(len(found) // 4)
                docs.append(doc)
                total += len(found) // 4
        if docs:
            yield flush()

    return run


_MANIFEST = "name string, part bigint, number bigint, ids bigint, docs bigint"


def write_ids(
    docs: DataFrame, model_path: str, end_id: int, folder: str, id_column: str = "doc_id", text_column: str = "text",
    block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of all texts in ascending order of id and return the manifest: name, part, number, ids, docs and
    ``start``, the index of the file's first id in the corpus.

    A null or empty text has the end id only. Null ids come first; rows with equal ids stand in the order of their
    texts. An empty table gives no file."""
    spark = docs.sparkSession
    prepare(spark)
    with open(model_path, "rb") as file:
        data = file.read()
    size = Tokenizer.from_str(data.decode()).get_vocab_size(with_added_tokens=True)
    bits = max(1, int(max(size - 1, end_id)).bit_length())
    model = spark.sparkContext.broadcast(data)
    key = model._jbroadcast.id()
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text"))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The start of a text is part of the range, so rows without an id, or with one id, are spread as well.
    rows = rows.repartitionByRange(count, "id", F.substring("text", 1, 64)).sortWithinPartitions("id", "text")
    written = rows.mapInArrow(tidy(_writer(key, model, folder, bits, end_id, block_ids, file_ids)), _MANIFEST)
    # One row per file: one small table, whatever the number of tasks, and a running sum over it, not over the data.
    manifest = save(written.repartition(1), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, one row per document."""
    found = manifest.agg(F.count("*").alias("files"), F.sum("ids").alias("ids")).collect()[0]
    # Small files share tasks.
    tasks = max(1, min(found["files"], -(-int(found["ids"] or 0) // READ_IDS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['name']}") as file:
                    packed = PackedFile(file)
                    step = 1024
                    for at in range(0, len(packed.docs), step):
                        first = packed.first[at : at + step + 1]
                        ids = packed.read(int(first[0]), int(first[-1]))
                        ids = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                        byte = ((first - first[0]) * 4).tolist()
                        sums = [zlib.crc32(ids[a:b]) for a, b in zip(byte[:-1], byte[1:])]
                        names = pa.array(packed.docs[at : at + step], mask=packed.nulls[at : at + step])
                        yield pa.RecordBatch.from_arrays(
                            [names, pa.array(first[:-1] + row["start"]), pa.array(np.diff(first)), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    spread = manifest.select("name", "start").repartition(tasks)
    return spread.mapInArrow(tidy(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def packed_folder(docs: DataFrame) -> str:
    """A new folder for files in the shared place."""
    return fresh(docs.sparkSession, "ids")
