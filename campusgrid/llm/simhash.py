"""SimHash near-duplicates: pigeonhole blocks, join on blocks, Hamming check, connected components.

A fingerprint bit is set if it is set in more than half of the hashes of a text's shingles. The bits are cut into
blocks; two fingerprints that differ in at most ``distance`` bits agree on any ``keep`` of the blocks that the
differing bits leave untouched. Every combination of ``keep`` blocks is a join key, fingerprints meet on keys, and
each group is compared in numpy: only verified links leave a task, and of those a spanning forest.

Equal fingerprints are joined to one before anything is compared. A group of more than ``tile`` fingerprints is cut
into tiles by a hash, and each pair of tiles is a task of its own, so that a common block neither lands in one task
nor loses a link. For ``blocks - keep >= distance`` the links are exact."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.components import components
from campusgrid.llm.shelf import prepare, save, tidy
from campusgrid.llm.words import find_words, mix, small_batches, string_column

_TEXT = "_text"


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bits set in more than half of the rows first[i]:first[i + 1]; columns are 64-bit words."""
    sizes = np.diff(first)
    out = np.zeros((len(sizes), hashes.shape[1]), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    for column in range(hashes.shape[1]):
        totals = np.empty((len(some), 64), dtype=np.int64)
        # A few thousand texts' bits at a time keep the expanded bits small.
        begin = 0
        while begin < len(some):
            end = int(np.searchsorted(first[some + 1], first[some[begin]] + (1 << 18), side="right"))
            end = min(max(end, begin + 1), len(some))
            part = np.ascontiguousarray(hashes[first[some[begin]] : first[some[end - 1] + 1], column])
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            totals[begin:end] = np.add.reduceat(bits, first[some[begin:end]] - first[some[begin]], axis=0, dtype=np.int32)
            begin = end
        packed = np.packbits(totals * 2 > sizes[some, None], axis=1, bitorder="little")
        out[some, column] = np.ascontiguousarray(packed).view(np.uint64)[:, 0]
    return out


def _shingle_places(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last+1 word of every shingle, and each text's shingles; a shorter text is one shingle."""
    words = np.diff(first)
    counts = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    total = np.concatenate([[0], np.cumsum(counts)])
    heads = np.repeat(first[:-1] - total[:-1], counts) + np.arange(total[-1])
    return heads, np.minimum(heads + size, np.repeat(first[1:], counts)), total


def exact_fingerprints(column: pa.Array, size: int, seed: int) -> np.ndarray:
    """64-bit fingerprints over XXH64 of the shingles as text, repeats included, ASCII letters lower-cased."""
    words = find_words(column, lower=True)
    joined, offsets = words.joined()
    lengths = words.ends - words.starts
    # Where word i begins in the joined text: texts have no trailing space.
    places = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] - np.cumsum(np.diff(words.first) > 0)[words.owner] + 1
    heads, tails, total = _shingle_places(words.first, size)
    view, digest = memoryview(np.ascontiguousarray(joined)), xxhash.xxh64_intdigest
    begins, ends = places[heads].tolist(), (places[tails - 1] + lengths[tails - 1]).tolist()
    found = np.fromiter((digest(view[b:e], seed) for b, e in zip(begins, ends)), dtype=np.uint64, count=len(heads))
    return _majority(found[:, None], total)


def _fixed(values: np.ndarray) -> pa.Array:
    width = values.shape[1] * 8
    return string_column(np.ascontiguousarray(values).view(np.uint8).reshape(-1), np.arange(len(values) + 1) * width, pa.binary())


def _prints(column: pa.Array, words: int) -> np.ndarray:
    """Fingerprints of a binary column without nulls as rows of 64-bit words."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, words), dtype=np.uint64)
    begin = int(np.frombuffer(offsets, dtype=np.int64, count=1, offset=column.offset * 8)[0])
    return np.frombuffer(data, dtype=np.uint8, count=len(column) * words * 8, offset=begin).copy().view(np.uint64).reshape(-1, words)


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    prepare(docs.sparkSession)
    ident, text = F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text_column}`")
    return docs.select(row_key(ident, text).alias("row_key"), ident.alias("id"), text.alias(_TEXT))


def fingerprints(docs: DataFrame, id_column: str, text_column: str, size: int, seed: int = 42) -> DataFrame:
    """Per row: ``row_key`` (hash of id and text), ``id`` and ``print``, the fingerprint (null text: all zero)."""
    keyed = _keyed(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _TEXT):
            column = batch.column(_TEXT)
            found = exact_fingerprints(column, size, seed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("id"), _fixed(found)], names=["row_key", "id", "print"]
            )

    return keyed.mapInArrow(tidy(run), "row_key bigint, id bigint, print binary")


def row_key(ident: Column, text: Column) -> Column:
    return F.xxhash64(ident.cast("bigint"), text)


def _block_rows(words: int, blocks: int, keep: int):
    edges = np.linspace(0, words * 64, blocks + 1).astype(int)
    chosen = list(combinations(range(blocks), keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                prints = _prints(batch.column("print"), words)
                bits = np.unpackbits(prints.view(np.uint8).reshape(len(prints), -1), axis=1, bitorder="little")
                values = []
                for low, high in zip(edges[:-1], edges[1:]):
                    part = np.zeros((len(prints), -(-(high - low) // 64) * 64), dtype=np.uint8)
                    part[:, : high - low] = bits[:, low:high]
                    value = np.packbits(part, axis=1, bitorder="little").view(np.uint64)
                    joined = value[:, 0]
                    for i in range(1, value.shape[1]):
                        joined = mix(joined) ^ value[:, i]
                    values.append(joined)
                keys = []
                for number, combination in enumerate(chosen):
                    key = np.full(len(prints), number, dtype=np.uint64)
                    for block in combination:
                        key = mix(key) ^ values[block]
                    keys.append(mix(key).view(np.int64))
                rows = pa.array(np.tile(np.arange(len(prints)), len(chosen)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), batch.column("node").take(rows), batch.column("print").take(rows)],
                    names=["key", "node", "print"],
                )

    return run


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _settle(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of every index, over links a-b."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _sweep(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one group: spread from a member to all unvisited ones within ``distance``."""
    left, a, b = np.arange(len(prints)), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = _differ(prints[left], prints[at]) <= distance
            hit = left[near]
            a.append(np.full(len(hit), at))
            b.append(hit)
            front.extend(hit.tolist())
            left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def _links(node: np.ndarray, prints: np.ndarray, first: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links within the groups first[i]:first[i + 1]."""
    sizes = np.diff(first)
    a, b = [], []
    for group in np.flatnonzero(sizes > 128):
        x, y = _sweep(prints[first[group] : first[group + 1]], distance)
        a.append(x + first[group])
        b.append(y + first[group])
    for size in np.unique(sizes[(sizes > 1) & (sizes <= 128)]):
        heads = first[:-1][sizes == size]
        i, j = np.triu_indices(size, 1)
        step = max(1, (1 << 20) // len(i))
        for at in range(0, len(heads), step):
            x = (heads[at : at + step, None] + i).ravel()
            y = (heads[at : at + step, None] + j).ravel()
            near = _differ(prints[x], prints[y]) <= distance
            a.append(x[near])
            b.append(y[near])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = _settle(len(node), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(label != np.arange(len(node)))
    return node[label[moved]], node[moved]


def _group_links(words: int, distance: int, lists: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                nodes, prints, owners = [], [], []
                for i in range(lists):
                    column = batch.column(f"members{i}")
                    members = column.flatten()
                    nodes.append(members.field("node").to_numpy(zero_copy_only=False))
                    prints.append(_prints(members.field("print"), words))
                    owners.append(np.repeat(np.arange(batch.num_rows), column.value_lengths().fill_null(0).to_numpy()))
                owner = np.concatenate(owners)
                order = np.argsort(owner, kind="stable")
                first = np.searchsorted(owner[order], np.arange(batch.num_rows + 1))
                a, b = _links(np.concatenate(nodes)[order], np.concatenate(prints)[order], first, distance)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def print_links(prints: DataFrame, bits: int, distance: int, blocks: int, keep: int, tile: int = 2048) -> DataFrame:
    """Verified links (a, b) that connect the same fingerprints as all links within ``distance`` do.

    ``prints`` has one row per distinct fingerprint: ``node`` (bigint) and ``print``."""
    words = bits // 64
    # Made anew for either use: the fingerprints are a few bytes each, their block rows many times that.
    keyed = prints.mapInArrow(tidy(_block_rows(words, blocks, keep)), "key bigint, node bigint, print binary")
    sizes = keyed.groupBy("key").count()
    hot = save(
        sizes.where(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "hot"
    )
    member = F.struct("node", "print")
    plain = (
        keyed.join(hot, "key", "left_anti").groupBy("key").agg(F.collect_list(member).alias("members0"))
        .where("size(members0) > 1").select("members0")
    )
    found = plain.mapInArrow(tidy(_group_links(words, distance, 1)), "a bigint, b bigint")
    if not hot.isEmpty():
        tiles = save(
            keyed.join(hot, "key").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
            .groupBy("key", "tile").agg(F.first("tiles").alias("tiles"), F.collect_list(member).alias("members")), "tiles",
        )
        # A tile meets itself and every later one; each pair of tiles is a row of its own.
        left = tiles.select("key", F.col("members").alias("members0"), F.col("tile").alias("from"),
                            F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("tile"))
        right = tiles.select("key", "tile", F.col("members").alias("members1"))
        pairs = left.join(right, ["key", "tile"]).select(
            "members0", F.when(F.col("from") < F.col("tile"), F.col("members1")).alias("members1")
        )
        pairs = pairs.repartition(F.xxhash64("members0", "members1"))
        found = found.unionByName(pairs.mapInArrow(tidy(_group_links(words, distance, 2)), "a bigint, b bigint"))
    return found.distinct()


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3, seed: int = 42,
    distance: int = 2, blocks: int = 4,
) -> DataFrame:
    """Per row: ``row_key``, ``id``, ``print`` (8 bytes, low byte first), ``component_id``: the smallest id reachable over fingerprints that differ in at most ``distance`` bits. Exact: any two such fingerprints agree on ``blocks -
    distance`` blocks.

    Fewer than ``size`` words make one shingle; no words (null, empty) make fingerprint zero, which links like any
    other. A row with a null id has no number to give to a group: it gets the group's id if a row with an id has its
    fingerprint, else null, and does not link other fingerprints. Repeated rows
    are kept. An empty table gives no rows."""
    marked = save(fingerprints(docs, id_column, text_column, size, seed), "marked")
    nodes = save(marked.where("id is not null").groupBy("print").agg(F.min("id").alias("node")), "prints")
    moved = components(print_links(nodes, 64, distance, blocks, blocks - distance))
    groups = save(
        nodes.join(moved, "node", "left").select("print", F.coalesce("component", "node").alias("component_id")), "groups"
    )
    return marked.join(groups, "print", "left").select("row_key", "id", "print", "component_id")
