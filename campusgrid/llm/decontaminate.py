"""Benchmark passages in training texts, found by a generalised suffix automaton of the test items.

The automaton is over words and holds every run of words of every item; each text is streamed through it, and the
length of the longest run that ends at a word and occurs in an item is known at every word. Items are dealt into
shards of a bounded number of words (a longer item in overlapping pieces), each shard makes one automaton, and texts
pass the shards one after the other, so that a task holds one bounded automaton however large the benchmark is."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from campusgrid.llm.shelf import prepare, save, tidy
from campusgrid.llm.words import Words, find_words, small_batches, string_column

#: Words are runs of other bytes than these: digits, a-z and everything beyond ASCII make words.
_BREAKS = np.ones(256, dtype=bool)
_BREAKS[ord("0") : ord("9") + 1] = _BREAKS[ord("A") : ord("Z") + 1] = _BREAKS[ord("a") : ord("z") + 1] = False
_BREAKS[0x80:] = False

_MADE = "struct<n_words: bigint, n_hit: bigint, longest: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<string>>"


class SuffixAutomaton:
    """All runs of words of the items added, with states joined by suffix links.

    ``step`` and ``link`` and ``size`` are the automaton; a state's ``size`` is its longest run. ``close`` adds, for
    windows of ``window`` words: ``full``, the state of a state's last ``window`` words; ``short``, the nearest state on
    the way along the links that is a whole item of fewer words; ``owners``, the items of such states."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.items: list[tuple[str | None, list[int], bool]] = []

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """Runs of ``target`` no longer than one word more than ``state`` in a state of their own."""
        part = self._state(self.size[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = part
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, word: int) -> int:
        there = self.step[last].get(word)
        if there is not None:  # an earlier item has this run
            return there if self.size[there] == self.size[last] + 1 else self._split(last, word, there)
        new = self._state(self.size[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            there = self.step[state][word]
            self.link[new] = there if self.size[there] == self.size[state] + 1 else self._split(state, word, there)
        return new

    def add(self, item: str | None, words: list[int], whole: bool = True) -> None:
        """``whole``: false for a piece of a longer item."""
        last = 0
        for word in words:
            last = self._extend(last, word)
        self.items.append((item, words, whole))

    def close(self, window: int) -> None:
        states = len(self.size)
        self.full, self.short = [-1] * states, [-1] * states
        self.owners: dict[int, set[str]] = {}
        for state in sorted(range(1, states), key=self.size.__getitem__):
            link = self.link[state]
            if self.size[state] >= window:
                self.full[state] = state if self.size[link] < window else self.full[link]
        whole = set()
        for item, words, complete in self.items:
            at = 0
            for n, word in enumerate(words, 1):
                at = self.step[at][word]
                if n >= window:
                    self._own(self.full[at], item)
            if complete and 0 < len(words) < window:
                whole.add(at)
                self._own(at, item)
        for state in sorted(range(1, states), key=self.size.__getitem__):
            self.short[state] = state if state in whole else self.short[self.link[state]]
        del self.items

    def _own(self, state: int, item: str | None) -> None:
        owners = self.owners.setdefault(state, set())
        if item is not None:
            owners.add(item)

    def stream(self, words: Iterable[int], window: int) -> Iterator[tuple[int, int, int]]:
        """(place, length, state) of every window that ends at a place; ``length`` words before the end are hit."""
        step, link, size, full, short = self.step, self.link, self.size, self.full, self.short
        state = length = 0
        for place, word in enumerate(words):
            there = step[state].get(word)
            while there is None and state:
                state = link[state]
                length = size[state]
                there = step[state].get(word)
            if there is None:
                continue
            state, length = there, length + 1
            if length >= window:
                yield place, length, full[state]
            whole = short[state]
            if whole == state and size[state] > length:
                whole = short[link[state]]
            while whole > 0:
                yield place, size[whole], whole
                whole = short[link[whole]]


def _item_words(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item, words) of the items that have words."""
    texts = items.select(F.col(f"`{id_column}`").cast("string").alias("item"), F.col(f"`{text_column}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch], "text"):
                words = find_words(part.column("text"), lower=True, breaks=_BREAKS)
                data = words.data.tobytes()
                each = [data[a:b].decode() for a, b in zip(words.starts.tolist(), words.ends.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(words.first, pa.int32()), pa.array(each, pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("item"), lists], names=["item", "words"])

    found = texts.where("text is not null").mapInArrow(run, "item string, words array<string>")
    return found.where(F.size("words") > 0).distinct()


def _pieces(found: DataFrame, window: int, most: int) -> tuple[DataFrame, int]:
    """Items in pieces with their shard of at most about ``most`` words, and the number of shards.

    Pieces are a sixteenth of a shard at most, so that shards fill evenly, and overlap by ``window`` - 1 words, so
    that every window is in one of them."""
    piece = max(2 * window, most // 16)
    stride = piece - window + 1
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - window), F.lit(stride))
    cut = found.select("item", "words", F.size("words").alias("n"), F.explode(starts).alias("at"))
    cut = cut.select("item", "at", F.slice("words", F.col("at") + 1, piece).alias("words"), (F.col("n") <= piece).alias("whole"))
    cut = save(cut, "item_pieces")
    # Lanes of a hash fill shards one after the other, so only the sizes of lanes go to the driver.
    lanes = cut.withColumn("lane", F.pmod(F.xxhash64("item", "at", "words"), F.lit(4096)))
    sizes = lanes.groupBy("lane").agg(F.sum(F.size("words")).alias("n")).orderBy("lane").collect()
    shard, filled, rows = 0, 0, []
    for r in sizes:
        parts = -(-2 * r["n"] // most)  # a lane too large for one shard is dealt over several
        if filled and (filled + r["n"] > most or parts > 1):
            shard, filled = shard + 1, 0
        rows.append((r["lane"], shard, max(1, parts)))
        filled += r["n"]
        if parts > 1:
            shard, filled = shard + parts, 0
    count = shard + bool(filled)
    if not rows:
        return cut.withColumn("shard", F.lit(0)), 0
    plan = cut.sparkSession.createDataFrame(rows, "lane bigint, shard int, parts int")
    dealt = lanes.join(plan, "lane").withColumn("shard", F.col("shard") + F.pmod(F.hash("words", "item"), F.col("parts")))
    return dealt.select("shard", "item", "words", "whole"), count


def _automata(items: DataFrame, id_column: str, text_column: str, window: int, most: int):
    """(words, their numbers' places, automaton) of one shard after the other; the driver holds one at a time."""
    dealt, count = _pieces(_item_words(items, id_column, text_column), window, most)
    for shard in range(count):
        rows = dealt.where(F.col("shard") == shard).select("item", "words", "whole").collect()
        known = sorted({w for r in rows for w in r["words"]})
        automaton = SuffixAutomaton()
        for r in sorted(rows, key=lambda r: (r["words"], r["item"] or "")):
            automaton.add(r["item"], [bisect_left(known, w) for w in r["words"]], r["whole"])
        automaton.close(window)
        if known:
            yield known, automaton


class _Vocabulary:
    """Numbers of words by their 64-bit hashes; a word whose hash is known is compared byte by byte."""

    def __init__(self, known: list[str]) -> None:
        column = pa.array(known, pa.string())
        words = find_words(column, lower=False, breaks=_BREAKS)
        hashes = words.hashes()
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.words = words

    def numbers(self, words: Words) -> np.ndarray:
        """The number of every word, -1 if no item has it."""
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = np.where(self.hashes[at] == hashes, self.order[at], -1)
        some = np.flatnonzero(found >= 0)
        own, sizes = self.words, words.ends[some] - words.starts[some]
        same = sizes == (own.ends - own.starts)[found[some]]
        some, sizes = some[same], sizes[same]
        places = np.concatenate([[0], np.cumsum(sizes)])
        within = np.arange(places[-1]) - np.repeat(places[:-1], sizes)
        left = words.data[np.repeat(words.starts[some], sizes) + within]
        right = own.data[np.repeat(own.starts[found[some]], sizes) + within]
        differ = np.concatenate([[0], np.cumsum(left != right)])
        sure = differ[places[1:]] == differ[places[:-1]]
        out = np.full(len(hashes), -1, dtype=np.int64)
        out[some[sure]] = found[some[sure]]
        return out


def _runs(numbers: np.ndarray, owner: np.ndarray, pairs: np.ndarray, many: int, least: int) -> list[tuple[int, int]]:
    """Runs of at least ``least`` words of a text in which every word is known and every two neighbours are a path of
    the automaton: no window reaches beyond such a run."""
    known = numbers >= 0
    joined = np.zeros(len(numbers), dtype=bool)
    if len(numbers) > 1:
        both = known[1:] & known[:-1] & (owner[1:] == owner[:-1])
        code = numbers[:-1] * many + numbers[1:]
        at = np.minimum(np.searchsorted(pairs, code), max(len(pairs) - 1, 0))
        joined[1:] = both & (pairs[at] == code) if len(pairs) else False
    starts = np.flatnonzero(known & ~joined)
    after = np.append(~joined[1:], True) if len(numbers) else joined
    stops = np.flatnonzero(known & after) + 1
    long = stops - starts >= least
    return list(zip(starts[long].tolist(), stops[long].tolist()))


def _scan(model, window: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, automaton = model.value
        vocabulary, many = _Vocabulary(known), len(known)
        first = automaton.step[0]
        pairs = np.array(sorted(a * many + b for a, s in first.items() for b in automaton.step[s]), dtype=np.int64)
        least = min([window, *(automaton.size[s] for s in automaton.owners)])
        for batch in batches:
            for part in small_batches([batch], text):
                words = find_words(part.column(text), lower=True, breaks=_BREAKS)
                numbers, owner = vocabulary.numbers(words), words.owner
                spans: dict[int, list[tuple[int, int]]] = {}
                states: dict[int, set[int]] = {}
                for start, stop in _runs(numbers, owner, pairs, many, least):
                    doc = int(owner[start])
                    base = start - int(words.first[doc])
                    for place, length, state in automaton.stream(numbers[start:stop].tolist(), window):
                        spans.setdefault(doc, []).append((base + place - length + 1, base + place + 1))
                        states.setdefault(doc, set()).add(state)
                made = []
                before = part.column("made").to_pylist()
                for doc, n in enumerate(words.counts.tolist()):
                    old = before[doc] or {"longest": 0, "spans": [], "items": []}
                    fresh = spans.get(doc, [])
                    merged = _merged([(s["start"], s["stop"]) for s in old["spans"]] + fresh)
                    items = set(old["items"]).union(*(automaton.owners[s] for s in states.get(doc, ())))
                    made.append({
                        "n_words": n, "n_hit": sum(b - a for a, b in merged),
                        "longest": max([old["longest"], *(b - a for a, b in fresh)]),
                        "spans": [{"start": a, "stop": b} for a, b in merged], "items": sorted(items),
                    })
                at = part.schema.get_field_index("made")
                yield part.set_column(at, "made", pa.array(made, part.schema.field("made").type))

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlap, in order; spans that only touch stay apart."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(text: str):
    """The text without the words of its spans, and without what stands between the words of a span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch], text):
                words = find_words(part.column(text), lower=False, breaks=_BREAKS)
                keep = np.ones(len(words.data), dtype=bool)
                lists = part.column("made").field("spans")
                doc = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                spans = lists.flatten()
                if len(spans):
                    base = words.first[doc]
                    starts = words.starts[base + spans.field("start").to_numpy()].tolist()
                    stops = words.ends[base + spans.field("stop").to_numpy() - 1].tolist()
                    for a, b in zip(starts, stops):
                        keep[a:b] = False
                places = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
                kept = string_column(words.data[keep], places)
                if part.column(text).null_count:
                    kept = pa.array([None if gone else t for t, gone in zip(kept.to_pylist(), part.column(text).is_null().to_pylist())])
                yield pa.RecordBatch.from_arrays([*part.columns, kept], names=[*part.schema.names, "kept_text"])

    return run


def decontaminate(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_coverage: float = 0.5, text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text", shard_words: int = 1 << 18, keep_text: bool = True,
) -> DataFrame:
    """Per document: ``row`` (its columns, without the text if ``keep_text`` is false), ``n_words``, ``n_hit`` (words in
    spans), ``longest`` (words of the longest hit run that an item has as well, 0 without hits; in items of more than
    shard_words / 16 words, within a piece of them), ``spans`` (word places, stop excluded),
    ``items`` (texts of ids, sorted), ``dropped`` and, with ``keep_text``, ``kept_text``.

    A-Z are lowered; words are runs of digits, letters a-z and characters beyond ASCII. A window is ``window``
    consecutive words of an item, or a whole item of fewer words. Every occurrence of a window in a text is hit; runs of
    overlapping occurrences are the spans, which ``kept_text`` leaves out. A document of which more than ``max_coverage`` of the words
    is hit is marked ``dropped``.

    A null or empty text has no words, no hit, and stays as it is; an item without words has no window. Items with one id
    count once; an item with a null id hits words but is not listed. Repeated documents and null ids are kept, one row
    each; columns may have any names, as they are inside ``row``. No items: nothing is hit; no documents: no rows. All
    of a text is searched; matching words are compared byte by byte, so no hash decides.

    A task holds one automaton of at most ``shard_words`` words (some 100 MB at 2^18); a larger benchmark makes several,
    which texts pass one after the other."""
    spark = docs.sparkSession
    prepare(spark)
    if window < 1 or shard_words < 2 * window:
        raise ValueError("window must be positive and shard_words at least twice as many")
    columns = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_column]
    row = F.struct(*columns) if columns else F.struct(F.lit(0).alias("none"))
    frame = docs.select(row.alias("row"), F.col(f"`{text_column}`").alias("text"), F.lit(None).cast(_MADE).alias("made"))
    kind = frame.schema
    model = None
    for known, automaton in _automata(items, item_id, item_text, window, shard_words):
        if model:
            frame = save(frame, "scanned")
            model.destroy()
        model = spark.sparkContext.broadcast((known, automaton))
        frame = frame.mapInArrow(tidy(_scan(model, window, "text")), kind)
    if not model:
        frame = frame.mapInArrow(tidy(_scan_none("text")), kind)
    if keep_text:
        frame = frame.mapInArrow(tidy(_kept("text")), StructType([*kind, StructField("kept_text", StringType())]))
    share = F.when(F.col("made.n_words") > 0, F.col("made.n_hit") / F.col("made.n_words")).otherwise(0.0)
    texts = ["kept_text"] if keep_text else []
    return frame.select("row", "made.*", (share > max_coverage).alias("dropped"), *texts)


def _scan_none(text: str):
    """Counts of words where no item has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch], text):
                counts = find_words(part.column(text), lower=True, breaks=_BREAKS).counts.tolist()
                made = [{"n_words": n, "n_hit": 0, "longest": 0, "spans": [], "items": []} for n in counts]
                at = part.schema.get_field_index("made")
                yield part.set_column(at, "made", pa.array(made, part.schema.field("made").type))

    return run
