"""Removal of repeated passages: seeds, extension to both sides, maximal repeats.

A window is ``window`` consecutive words of one document. Words covered by a window that also starts in a
document with a smaller id are removed.

* Seeds. Every window owns one anchor, the ``seed``-word sequence in it with the smallest hash, so equal windows
  own equal anchors at equal places. Neighbouring windows mostly share their anchor; the windows of one anchor form
  a stretch of words around it (winnowing: about one anchor for 16 words). Documents meet on anchors.
* Extension. Anchors of a single document are dropped. An anchor's whole stretch (all words to the left and right
  that its windows reach) is compared by hash first: where an earlier document has the same stretch, all its windows
  repeat. Only the first document of every distinct stretch is left, and if its anchor has several stretches, it is
  compared window by window, for every extent to the left and right of the anchor.
* Maximal repeats are the unions of the repeated windows; they are cut out of the words.

No pair of documents is ever listed: groups are reduced to their smallest id with a map-side part, and only that id
is joined back. Hashes are 64-bit, and windows and stretches are compared with the hash of their anchor as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.shelf import prepare, save, tidy
from campusgrid.llm.words import find_words, small_batches, span_hashes, string_column

WINDOW, SEED = 50, 20
_TEXT, _ID, _ROW = "_text", "_id", "_row_key"


def _stretches(first: np.ndarray, hashes: np.ndarray, window: int, seed: int):
    """Runs of windows with a common anchor: (text, first window, last window, anchor place, anchor hash)."""
    span = window - seed + 1
    if len(hashes) < window:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    at = np.arange(len(hashes) - seed + 1)
    seeds = span_hashes(hashes, at, at + seed)
    place = np.lib.stride_tricks.sliding_window_view(seeds, span).argmin(axis=1) + np.arange(len(seeds) - span + 1)
    counts = np.maximum(np.diff(first) - window + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    begins = np.repeat(first[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = place[begins]
    new = np.ones(len(begins), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(begins))[: len(heads)] - 1
    return owner[heads], begins[heads], begins[tails], place[heads], seeds[place[heads]]


def _anchor_rows(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _TEXT):
            words = find_words(batch.column(_TEXT))
            hashes = words.hashes()
            text, head, tail, place, anchor = _stretches(words.first, hashes, window, seed)
            stretch = span_hashes(hashes, head, tail + window) + (place - head).astype(np.uint64)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), batch.column(_ID).take(rows),
                 batch.column(_ROW).take(rows), pa.array((head - words.first[text]).astype(np.int32))],
                names=["anchor", "stretch", "id", "row_key", "at"],
            )

    return run


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list<int> column; a null list is empty."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _window_rows(window: int, seed: int):
    """Hashes of all windows of the listed stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _TEXT):
            words = find_words(batch.column(_TEXT))
            hashes = words.hashes()
            text, head, tail, place, anchor = _stretches(words.first, hashes, window, seed)
            wanted, places = _ragged(batch.column("expand"))
            listed = np.repeat(words.first[:-1], np.diff(places)) + wanted
            chosen = np.isin(head, listed)
            text, head, tail, place, anchor = (x[chosen] for x in (text, head, tail, place, anchor))
            size = tail - head + 1
            group = np.repeat(np.arange(len(head)), size)
            begins = head[group] + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found = span_hashes(hashes, begins, begins + window) + (place[group] - begins).astype(np.uint64)
            rows = pa.array(text[group])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[group].view(np.int64)), pa.array(found.view(np.int64)), batch.column(_ID).take(rows),
                 batch.column(_ROW).take(rows), pa.array((begins - words.first[text[group]]).astype(np.int32))],
                names=["anchor", "window", "id", "row_key", "at"],
            )

    return run


def _cut(window: int, seed: int, rejoin: bool):
    """Texts without the words of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _TEXT):
            words = find_words(batch.column(_TEXT))
            depth = np.zeros(len(words.starts) + window + 1, dtype=np.int64)
            whole, places = _ragged(batch.column("whole"))
            if len(whole):
                _, head, tail, _, _ = _stretches(words.first, words.hashes(), window, seed)
                listed = np.repeat(words.first[:-1], np.diff(places)) + whole
                chosen = np.isin(head, listed)
                np.add.at(depth, head[chosen], 1)
                np.add.at(depth, tail[chosen] + window, -1)
            single, places = _ragged(batch.column("single"))
            begins = np.repeat(words.first[:-1], np.diff(places)) + single
            np.add.at(depth, begins, 1)
            np.add.at(depth, begins + window, -1)
            gone = np.cumsum(depth)[: len(words.starts)] > 0
            removed = np.bincount(words.owner[gone], minlength=batch.num_rows)
            kept = string_column(*words.joined(~gone))
            if not rejoin:
                kept = pc.if_else(pa.array(removed > 0), kept, batch.column(_TEXT))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), kept],
                names=["row", "n_words", "n_removed", "kept_text"],
            )

    return run


_SITE = "anchor bigint, {} bigint, id bigint, row_key bigint, at int"


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, seed: int = SEED,
    rejoin: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of its other columns), ``n_words``, ``n_removed``, ``kept_text``.

    A null text has no words; a text of fewer than ``window`` words is kept whole. A row with a null id is kept
    whole and takes nothing from others. Rows with the same id do not remove each other's words, and a row that
    occurs twice is returned twice. An empty table gives no rows. ``kept_text`` joins the kept words
    by one space; without ``rejoin`` a text that loses nothing stays as it is."""
    spark = docs.sparkSession
    prepare(spark)
    ident = F.col(f"`{id_column}`").cast("bigint")
    text = F.col(f"`{text_column}`")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row"),
        ident.alias(_ID), text.alias(_TEXT), F.xxhash64(ident, text).alias(_ROW),
    )
    plain = keyed.select(_ID, _TEXT, _ROW).where(F.col(_ID).isNotNull())

    sites = save(plain.mapInArrow(tidy(_anchor_rows(window, seed)), _SITE.format("stretch")), "anchors")
    shared = (
        sites.groupBy("anchor")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min("stretch").alias("s0"), F.max("stretch").alias("s1"))
        .where("low < high").select("anchor", (F.col("s0") < F.col("s1")).alias("several"))
    )
    # Both sides of each join below are read from files, so a hot anchor can be split.
    sites = save(sites.join(save(shared, "shared"), "anchor"), "sites")
    firsts = save(sites.groupBy("anchor", "stretch").agg(F.min("id").alias("first")), "firsts")
    state = sites.join(firsts, ["anchor", "stretch"])
    repeated, rest = F.col("first") < F.col("id"), F.col("several") & (F.col("first") == F.col("id"))
    listed = save(
        state.where(repeated | rest).groupBy("row_key").agg(
            F.collect_set(F.when(repeated, F.col("at"))).alias("whole"),
            F.collect_set(F.when(rest, F.col("at"))).alias("expand"),
        ), "listed",
    )

    expand = listed.where("size(expand) > 0").select(F.col("row_key").alias(_ROW), "expand")
    windows = save(
        plain.join(expand, _ROW).select(_ID, _TEXT, _ROW, "expand")
        .mapInArrow(tidy(_window_rows(window, seed)), _SITE.format("window")), "windows",
    )
    lowest = windows.groupBy("anchor", "window").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    lowest = save(lowest.where("first < last").select("anchor", "window", "first"), "lowest")
    single = (
        windows.join(lowest, ["anchor", "window"]).where("first < id")
        .groupBy("row_key").agg(F.collect_set("at").alias("single"))
    )

    marks = save(
        listed.where("size(whole) > 0").select("row_key", "whole").join(single, "row_key", "full")
        .select(F.col("row_key").alias(_ROW), "whole", "single"), "marks",
    )
    marked = keyed.join(marks, _ROW, "left").select("row", _TEXT, "whole", "single")
    schema = T.StructType(
        [marked.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
         T.StructField("kept_text", T.StringType())]
    )
    return marked.mapInArrow(tidy(_cut(window, seed, rejoin)), schema)
