"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding follows the model's merge rules: of all adjacent symbols whose joined text is a piece, the pair with the
best score (leftmost among equals) is merged until none is left. With dropout a candidate merge, that is a pair of
adjacent spans of characters, is skipped for good if a keyed hash of (seed, document, unit, span borders) falls
below ``dropout``. So a document's segmentation depends on its id, its text and the seed only, other seeds give
other segmentations, and all of them decode to the same text.

Pieces of this model type hold spaces at their front only, so a text falls into units (spaces and the characters
after them) that never share a piece. Units of equal length are encoded together, as rows of a numpy matrix; every
step merges the best candidate of each row. Long units are cut where no piece has the two characters side by side;
parts that stay long use an agenda (heap). Characters that the model lacks
are written as byte pieces. A literal U+2581, which the model uses for the space, is written as bytes too, so
decoding restores every text exactly."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.shelf import prepare, tidy
from campusgrid.llm.words import mix, small_batches, string_column, text_bytes

SPACE = "▁"
_NONE = np.int32(2**31 - 1)
_LONG = 48
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Lookup tables of a model."""

    size: int
    char: np.ndarray  # piece of a code point, or -1
    byte: np.ndarray  # piece of a byte
    space: int
    keys: np.ndarray  # open hash table of (left, right) -> order of the merged piece
    values: np.ndarray
    probes: int
    order: np.ndarray  # piece by order, best first
    data: np.ndarray  # the pieces' bytes, one after the other
    begin: np.ndarray
    length: np.ndarray
    table: dict[int, int]  # left * size + right -> order, for one pair at a time
    inner: np.ndarray  # sorted left * size + right of all neighbours within pieces, as single characters

    def merge_order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Order of the piece that the pair makes, or _NONE."""
        code = left.astype(np.uint64) * np.uint64(self.size) + right.astype(np.uint64)
        limit = np.uint64(len(self.keys) - 1)
        slot = (code * _GOLD) >> np.uint64(64 - (len(self.keys) - 1).bit_length())
        found = self.keys[slot]
        out = np.where(found == code, self.values[slot], _NONE)
        open_ = np.flatnonzero((found != code) & (found != ~np.uint64(0)))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + np.uint64(1)) & limit
            found = self.keys[slot[open_]]
            hit = found == code[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != ~np.uint64(0))]
        return out


def load_pieces(model: bytes) -> Pieces:
    p = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = p.get_piece_size()
    texts = [p.id_to_piece(i) for i in range(size)]
    bytes_ = [i for i in range(size) if p.is_byte(i)]
    plain = {t: i for i, t in enumerate(texts) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))}
    if len(bytes_) != 256 or any(SPACE in t.lstrip(SPACE) for t in plain) or SPACE not in plain:
        raise ValueError("the model must have byte pieces and spaces at the front of pieces only")
    char = np.full(0x110000, -1, dtype=np.int32)
    byte = np.zeros(256, dtype=np.int32)
    for i in bytes_:
        byte[int(texts[i][3:-1], 16)] = i
    for t, i in plain.items():
        if len(t) == 1 and t != SPACE:
            char[ord(t)] = i
    char[0x20] = plain[SPACE]
    order = np.array(sorted(plain.values(), key=lambda i: (-p.get_score(i), i)), dtype=np.int32)
    rank = np.zeros(size, dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    pairs = [
        (plain[t[:k]] * size + plain[t[k:]], rank[i])
        for t, i in plain.items() for k in range(1, len(t)) if t[:k] in plain and t[k:] in plain
    ]
    slots = 1 << max(10, (4 * len(pairs)).bit_length())
    keys, values, probes = np.full(slots, ~np.uint64(0)), np.zeros(slots, dtype=np.int32), 0
    codes = np.array([c for c, _ in pairs], dtype=np.uint64)
    homes = ((codes * _GOLD) >> np.uint64(64 - (slots - 1).bit_length())).astype(np.int64)
    for (code, value), home in zip(pairs, homes.tolist()):
        step = 0
        while keys[(home + step) % slots] != ~np.uint64(0):
            step += 1
        keys[(home + step) % slots], values[(home + step) % slots] = code, value
        probes = max(probes, step)
    symbol = {t: i for t, i in plain.items() if len(t) == 1}
    inner = {symbol[a] * size + symbol[b] for t in plain for a, b in zip(t, t[1:]) if a in symbol and b in symbol}
    raw = [t.replace(SPACE, " ").encode() for t in texts]
    for i in range(size):
        if p.is_control(i) or p.is_unknown(i):
            raw[i] = b""
    for b, i in enumerate(byte):
        raw[i] = bytes([b])
    length = np.array([len(x) for x in raw], dtype=np.int64)
    return Pieces(size, char, byte, plain[SPACE], keys, values, probes, order,
                  np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum(length) - length, length,
                  dict(pairs), np.array(sorted(inner), dtype=np.int64))


def _skipped(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the candidate that joins [start, mid) and [mid, end) of a unit is skipped."""
    spot = (start.astype(np.uint64) << np.uint64(42)) | (mid.astype(np.uint64) << np.uint64(21)) | end.astype(np.uint64)
    return mix(key ^ (spot * _GOLD)) < limit


def _orders(pieces: Pieces, left, right, key, base, start, mid, end, limit: np.uint64) -> np.ndarray:
    """``base``: where in their unit the spans are counted from."""
    out = pieces.merge_order(left, right)
    if limit:
        some = np.flatnonzero(out != _NONE)
        begin = base[some]
        out[some[_skipped(key[some], start[some] + begin, mid[some] + begin, end[some] + begin, limit)]] = _NONE
    return out


def _closed(table: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Each row without one column: the columns where ``after`` holds come from the next place."""
    return np.where(after, table[:, 1:], table[:, :-1])


def _encode_rows(pieces: Pieces, symbols: np.ndarray, key: np.ndarray, base: np.ndarray, limit: np.uint64):
    """Merge each row of a matrix of symbols; yields (rows, symbols) of equal final length. ``base``: where rows begin in
    their units."""
    rows, width = np.arange(len(symbols)), symbols.shape[1]
    columns = np.arange(width, dtype=np.uint8)
    edges = np.tile(np.arange(width + 1, dtype=np.uint8), (len(rows), 1))
    orders = _orders(
        pieces, symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), np.repeat(key, width - 1) if limit else key,
        np.repeat(base, width - 1) if limit else base, edges[:, :-2].ravel(), edges[:, 1:-1].ravel(), edges[:, 2:].ravel(), limit,
    ).reshape(len(rows), width - 1)
    while True:
        at = orders.argmin(axis=1).astype(np.uint8)
        line = np.arange(len(rows))
        best = orders[line, at]
        done = best == _NONE
        if done.any():
            yield rows[done], symbols[done]
            go = np.flatnonzero(~done)
            held = (rows, symbols, edges, orders, key, base, at, best)
            rows, symbols, edges, orders, key, base, at, best = (x.take(go, axis=0) for x in held)
            line = line[: len(go)]
        if not len(rows):
            return
        symbols[line, at] = pieces.order[best]
        if width == 2:
            yield rows, symbols[:, :1]
            return
        after = columns[: width - 1] > at[:, None]
        symbols = _closed(symbols, after)
        edges = np.where(columns[:width] > at[:, None], edges[:, 1:], edges[:, :-1])
        # Of the candidates beside the merged pair one column closes up, and both are computed anew.
        orders = _closed(orders, after[:, : width - 2])
        width -= 1
        at = at.astype(np.int64)
        for shift in (-1, 0):
            ok = np.flatnonzero(at > 0) if shift else np.flatnonzero(at < width - 1)
            s = at[ok] + shift
            orders[ok, s] = _orders(
                pieces, symbols[ok, s], symbols[ok, s + 1], key[ok], base[ok], edges[ok, s], edges[ok, s + 1], edges[ok, s + 2], limit
            )


_WORD = (1 << 64) - 1


def _mixed(x: int) -> int:
    """``mix`` of one number."""
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & _WORD
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & _WORD
    return x ^ x >> 33


def _encode_long(pieces: Pieces, symbols: np.ndarray, key: int, base: int, limit: int) -> np.ndarray:
    """One unit, or a part of one that begins at ``base``, by an agenda of candidates."""
    n, key, base, limit, gold = len(symbols), int(key), int(base), int(limit), int(_GOLD)
    table, size, order_of = pieces.table, pieces.size, pieces.order
    piece, end = symbols.tolist(), list(range(1, n + 1))
    before, after, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    agenda: list[tuple[int, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        order = table.get(piece[a] * size + piece[b])
        if order is None:
            return
        if limit:
            spot = (a + base) << 42 | (b + base) << 21 | (end[b] + base)
            if _mixed((key ^ spot * gold) & _WORD) < limit:
                return
        agenda.append((order, a, b, end[b]))

    for i in range(n - 1):
        offer(i, i + 1)
    heapq.heapify(agenda)
    while agenda:
        order, a, b, stop = heapq.heappop(agenda)
        if not (alive[a] and alive[b] and end[a] == b and end[b] == stop):
            continue
        piece[a], end[a], alive[b], after[a] = int(order_of[order]), stop, False, after[b]
        if after[a] >= 0:
            before[after[a]] = a
        for left, right in ((before[a], a), (a, after[a])):
            if left >= 0 and right >= 0:
                have = len(agenda)
                offer(left, right)
                if len(agenda) > have:
                    heapq.heappush(agenda, agenda.pop())
    return np.array([p for p, live in zip(piece, alive) if live], dtype=np.int32)


def _cut_long(pieces: Pieces, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places inside long units that no piece reaches across, as no piece has these two characters side by side."""
    long = np.flatnonzero(length > _LONG)
    if not len(long):
        return np.zeros(0, dtype=np.int64)
    sizes = length[long] - 1
    places = np.repeat(begin[long] - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes) + np.arange(sizes.sum()) + 1
    pair = symbols[places - 1].astype(np.int64) * pieces.size + symbols[places]
    at = np.minimum(np.searchsorted(pieces.inner, pair), len(pieces.inner) - 1)
    return places[pieces.inner[at] != pair]


def encode_column(pieces: Pieces, column: pa.Array, ids: np.ndarray, seed: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts of a column and where each text's begin. ``ids`` key the dropout."""
    data, offsets = text_bytes(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    sizes = np.diff(chars)
    # A space goes before every text that is not empty.
    full = sizes > 0
    symbols = np.insert(pieces.char[points], chars[:-1][full], pieces.space).astype(np.int32)
    points = np.insert(points, chars[:-1][full], 0x20)
    first = np.concatenate([[0], np.cumsum(sizes + full)])
    space, known = symbols == pieces.space, symbols >= 0
    cut = np.ones(len(symbols), dtype=bool)
    cut[1:] = (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1]
    cut[first[:-1][full]] = True
    begin = np.flatnonzero(cut)
    length = np.diff(np.append(begin, len(symbols)))
    unit_first = np.searchsorted(begin, first)
    text = np.repeat(np.arange(len(sizes)), np.diff(unit_first))
    number = np.arange(len(begin)) - unit_first[:-1][text]
    key = mix(mix(ids.astype(np.int64).view(np.uint64) ^ np.uint64(seed * 2 + 1))[text] + number.astype(np.uint64))
    # Long units fall apart where nothing can merge; the parts keep their unit's key and count from its start.
    base = np.zeros(len(begin), dtype=np.int64)
    more = _cut_long(pieces, symbols, begin, length)
    if len(more):
        units, begin = begin, np.union1d(begin, more)
        unit = np.searchsorted(units, begin, side="right") - 1
        base, key = begin - units[unit], key[unit]
        length = np.diff(np.append(begin, len(symbols)))
        unit_first = np.searchsorted(begin, first)
    limit = np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))

    counts = np.ones(len(begin), dtype=np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    single = (length == 1) & known[begin] if len(begin) else np.zeros(0, bool)
    parts.append((np.flatnonzero(single), symbols[begin[single]][:, None]))
    for size in np.unique(length[length > 1]):
        members = np.flatnonzero(length == size)
        if size > _LONG:
            for m in members:
                found = _encode_long(pieces, symbols[begin[m] : begin[m] + size], key[m], base[m], limit)
                counts[m] = len(found)
                parts.append((np.array([m]), found[None, :]))
            continue
        for at in range(0, len(members), 1 << 15):
            some = members[at : at + (1 << 15)]
            matrix = symbols[begin[some, None] + np.arange(size)].astype(np.int32)
            for rows, found in _encode_rows(pieces, matrix, key[some], base[some], limit):
                counts[some[rows]] = found.shape[1]
                parts.append((some[rows], found))
    lost = np.flatnonzero(~known[begin]) if len(begin) else np.zeros(0, int)
    point = points[begin[lost]]
    width = 1 + (point >= 0x80).astype(int) + (point >= 0x800) + (point >= 0x10000)
    for size in (1, 2, 3, 4):
        some, p = lost[width == size], point[width == size].astype(np.int64)
        if not len(some):
            continue
        raw = np.stack([0x80 | ((p >> (6 * (size - 1 - i))) & 0x3F) for i in range(size)], axis=1)
        lead = {1: p, 2: 0xC0 | (p >> 6), 3: 0xE0 | (p >> 12), 4: 0xF0 | (p >> 18)}[size]
        raw[:, 0] = lead
        counts[some] = size
        parts.append((some, pieces.byte[raw]))
    places = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(places[-1], dtype=np.int32)
    for units, found in parts:
        out[(places[units][:, None] + np.arange(found.shape[1]))] = found
    return out, places[unit_first]


def decode_pieces(pieces: Pieces, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts and their offsets."""
    length = pieces.length[values]
    places = np.concatenate([[0], np.cumsum(length)])
    data = pieces.data[np.repeat(pieces.begin[values] - places[:-1], length) + np.arange(places[-1])]
    offsets = places[first]
    full = np.diff(offsets) > 0
    keep = np.ones(len(data), dtype=bool)
    keep[offsets[:-1][full]] = False
    return data[keep], np.concatenate([[0], np.cumsum(np.diff(offsets) - full)])


def _tables(spark: SparkSession, model_path: str):
    """The model file's bytes for all tasks; each worker builds its tables once."""
    with open(model_path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


_loaded: dict[int, Pieces] = {}


def _pieces(shared) -> Pieces:
    if shared.id not in _loaded:
        _loaded.clear()
        _loaded[shared.id] = load_pieces(shared.value)
    return _loaded[shared.id]


class _Shared:
    """A broadcast with an identity that survives pickling."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self):
        return self.broadcast.value


def encode(
    docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``row`` (a struct of the other columns of ``docs``) and ``pieces`` (array of int).

    A null or empty text has no pieces. A null id keys the dropout like id 0; rows with equal id and text are encoded
    alike. ``dropout`` 0 gives the model's own segmentation, 1 gives single characters. No rows give no rows."""
    spark = docs.sparkSession
    prepare(spark)
    shared = _Shared(_tables(spark, model_path))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row"), F.col(f"`{text_column}`").alias("_text"),
        F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(0)).alias("_id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared)
        for batch in small_batches(batches, "_text"):
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            values, first = encode_column(pieces, batch.column("_text"), ids, seed, dropout)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], names=["row", "pieces"])

    schema = T.StructType([keyed.schema["row"], T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    return keyed.mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, model_path: str, pieces_column: str = "pieces") -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the text its pieces stand for (null or no pieces: empty)."""
    spark = encoded.sparkSession
    prepare(spark)
    shared = _Shared(_tables(spark, model_path))
    keyed = encoded.withColumn("decoded", F.lit(None).cast("string"))
    at = encoded.columns.index(pieces_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared)
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                column = batch.column(at)
                sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                values = column.flatten().to_numpy(zero_copy_only=False)
                first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                text = string_column(*decode_pieces(pieces, values, first))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], text], names=batch.schema.names)

    return keyed.mapInArrow(tidy(run), keyed.schema)
