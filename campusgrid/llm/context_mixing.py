"""Language-model scores by online logistic context mixing.

A text is a sequence of tokens: its words (ASCII letters lower-cased) and one end. Each token is written as binary
decisions on a path through a word tree (down to the single word, unless ``tree_depth`` ends it before), in which
frequent words have short paths; words outside the vocabulary take an escape and are spelled through a byte tree. Each decision is predicted by four bit predictors, all
learned from all training texts: the node alone, and the node hashed with three longer and longer contexts (for words:
the last very frequent word, the last token, the last two; for bytes: one, two and three bytes before). A longer
context's counts are smoothed towards the next shorter one's prediction. The predictions are mixed in the logistic
domain with weights chosen by a gate (tree and confidence of the two longest contexts); while a text is read, its
weights follow the coding error by online gradient steps, one for every ``BLOCK`` decisions. The logarithms of the
mixed probabilities add up to the text's score.

Three passes over the texts: count words, count decisions in their contexts, score. Word counts are a shuffled
aggregate. Context counts are tables of a fixed size (the model's capacity, ``SLOTS`` for each hashed context), filled
per task and added up in two steps. What all tasks need is bounded: the tables and a vocabulary of at most ``VOCABULARY`` words; counts of other words are joined."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.shelf import prepare, save, tidy
from campusgrid.llm.words import Words, find_words, mix, small_batches

VOCABULARY, SLOTS, CHUNK, BLOCK = 1 << 19, 1 << 20, 1 << 13, 128
#: Hash values that stand for the end and the escape; the count of the end is kept under END like a word's.
END, ESCAPE = 1, 2
_FREQUENT = 256
_LANES, _GATES = 4, 32
#: Decisions at a time that stay in cache.
_PART = 1 << 15
_NODE_SALT = np.uint64(0x9E3779B97F4A7C15)
START_WEIGHTS = (0.0, 0.0, 0.3, 0.7)
#: Gates by how often the two longest contexts were met: never, a few times, dozens of times, more.
_STRENGTH = 4.0
_CONFIDENCE = np.array([0.5, 7.5, 63.5], dtype=np.float32) + np.float32(_STRENGTH)


def token_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text followed by its end, and where texts begin."""
    first = words.first + np.arange(len(words.first))
    out = np.full(first[-1], END, dtype=np.uint64)
    keep = np.ones(len(out), dtype=bool)
    keep[first[1:] - 1] = False
    out[keep] = words.hashes()
    return out, first


@dataclass
class Tree:
    """Paths of symbols: ``nodes`` and ``bits`` of symbol s are at first[s]:first[s + 1]; ``rest`` is its log10 share."""

    first: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    rest: np.ndarray
    count: int


def build_tree(weights: np.ndarray, depth: int | None = None) -> Tree:
    """Halve the weight again and again in the given order, down to ``depth`` or to single symbols."""
    total = np.concatenate([[0], np.cumsum(weights.astype(np.float64))])
    leaf, size = np.arange(len(weights)), np.zeros(len(weights), dtype=np.int64)
    low, high = np.array([0]), np.array([len(weights)])
    count, levels = 0, []
    while True:  # a level of all paths at a time
        some = high - low > 1
        low, high = low[some], high[some]
        if not len(low) or len(levels) == depth:
            break
        cut = np.clip(np.searchsorted(total, (total[low] + total[high]) / 2), low + 1, high - 1)
        symbol, owner = _within(low, high)
        levels.append((symbol, (count + owner).astype(np.int32), symbol >= cut[owner]))
        size[symbol] += 1
        count += len(low)
        low, high = np.stack([low, cut], 1).ravel(), np.stack([cut, high], 1).ravel()
    symbol, owner = _within(low, high)
    leaf[symbol] = low[owner]
    first = np.concatenate([[0], np.cumsum(size)])
    nodes, bits = np.empty(first[-1], dtype=np.int32), np.empty(first[-1], dtype=np.uint8)
    for level, (symbol, node, bit) in enumerate(levels):
        at = first[symbol] + level
        nodes[at], bits[at] = node, bit
    sums = np.bincount(leaf, weights, minlength=len(weights))
    return Tree(first, nodes, bits, np.log10(weights / sums[leaf]), max(1, count))


def _within(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the intervals, and the interval of each."""
    owner = np.repeat(np.arange(len(low), dtype=np.int32), high - low)
    begin = np.cumsum(high - low) - (high - low)
    return (np.arange(len(owner)) + (low - begin)[owner]).astype(np.int32), owner


class Coder:
    """Symbols and contexts of token sequences. ``hashes`` and ``counts``: the vocabulary, most frequent first."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, byte_counts: np.ndarray, depth: int | None = None):
        order = np.argsort(hashes)
        self.sorted, self.symbol, self.counts = hashes[order], order, counts
        known = np.append(counts, max(1, total - counts.sum()))  # the escape is the last symbol
        by_weight = np.argsort(-known, kind="stable")
        tree = build_tree(np.maximum(known[by_weight], 0.5), depth)
        # Paths in the order of symbols.
        place = np.empty(len(known), dtype=np.int64)
        place[by_weight] = np.arange(len(known))
        length = np.diff(tree.first)[place]
        first = np.concatenate([[0], np.cumsum(length)])
        source = np.repeat((tree.first[place] - first[:-1]).astype(np.int32), length) + np.arange(first[-1], dtype=np.int32)
        self.word = Tree(first, tree.nodes[source], tree.bits[source], tree.rest[place], tree.count)
        self.byte = build_tree(byte_counts + 1.0)
        self.escape = len(counts)
        # Paths of all symbols, words before bytes, as node * 2 + bit.
        paths = [self.word.nodes * 2 + self.word.bits, (self.byte.nodes + self.word.count) * 2 + self.byte.bits]
        self.paths = np.concatenate(paths)
        self.path_first = np.concatenate([self.word.first, self.byte.first[1:] + self.word.first[-1]])
        self.path_size = np.diff(self.path_first)
        self.salt = np.arange(self.nodes).astype(np.uint64) * _NODE_SALT
        # An index by the leading bits makes look-ups short.
        self.lead = 64 - 20
        self.index = np.searchsorted(self.sorted >> np.uint64(self.lead), np.arange((1 << 20) + 1, dtype=np.uint64))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of every hash, or the escape."""
        if not len(self.sorted):
            return np.full(len(hashes), self.escape)
        lead = (hashes >> np.uint64(self.lead)).astype(np.int64)
        at, end = self.index[lead], self.index[lead + 1]
        out = np.full(len(hashes), self.escape, dtype=np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            spot = at[open_]
            hit = self.sorted[spot] == hashes[open_]
            out[open_[hit]] = self.symbol[spot[hit]]
            at[open_] += 1
            open_ = open_[~hit & (spot + 1 < end[open_])]
        return out

    def decisions(self, words: Words):
        """All decisions of a batch in order: where texts begin, node (byte nodes after word nodes), bit, and unit. Units
        are tokens, each followed by the letters it is spelled with; three context hashes per unit. And per text the
        log10 shares within last intervals, tokens' hashes and symbols, where texts begin in them, and all units."""
        place, path, *rest = self.path(words)
        return place, path >> 1, (path & 1).astype(np.uint8), *rest

    def path(self, words: Words):
        """The same with node * 2 + bit in one."""
        hashes, first = token_hashes(words)
        symbol = self.symbols(hashes)
        texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
        begin = np.zeros(len(hashes), dtype=bool)
        begin[first[:-1]] = True
        one = np.roll(hashes, 1)
        one[begin] = 3
        two = np.roll(one, 1)
        two[begin] = 3
        # The last very frequent word before a token (the vocabulary begins with the most frequent).
        often = (symbol < _FREQUENT) & (hashes != END)
        last = np.maximum.accumulate(np.where(often, np.arange(len(hashes)), -1))
        last = np.concatenate([[-1], last[:-1]]) if len(hashes) else last
        last = np.where(last >= first[:-1][texts], last, -1)
        topic = np.where(last >= 0, hashes[last], np.uint64(4))
        contexts = [topic, one ^ np.uint64(5), mix(two) ^ one]

        spelled = np.flatnonzero(symbol == self.escape)
        word = np.cumsum(hashes != END) - 1  # of each token in the batch's words
        letter_first, letters, letter_contexts = self._letters(words, word[spelled], topic[spelled])
        units, unit_of = symbol, np.arange(len(symbol) + 1)
        if len(letters):
            more = np.zeros(len(symbol), dtype=np.int64)
            more[spelled] = np.diff(letter_first)
            unit_of = np.arange(len(symbol) + 1) + np.concatenate([[0], np.cumsum(more)])
            letter_at = np.ones(unit_of[-1], dtype=bool)
            letter_at[unit_of[:-1]] = False
            merged = []
            for tokens, inner in zip([symbol, *contexts], [letters + self.escape + 1, *letter_contexts]):
                both = np.empty(len(letter_at), dtype=tokens.dtype)
                both[unit_of[:-1]], both[letter_at] = tokens, inner
                merged.append(both)
            units, *contexts = merged
        size = self.path_size[units]
        place = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat((self.path_first[units] - place[:-1]).astype(np.int32), size)
        source += np.arange(place[-1], dtype=np.int32)
        path = self.paths.take(source)
        unit = np.repeat(np.arange(len(units), dtype=np.int32), size)
        place = place[unit_of[first]]
        shares = np.bincount(texts, self.word.rest[symbol], minlength=len(first) - 1)
        if len(letters):
            owner = np.repeat(texts[spelled], np.diff(letter_first))
            shares += np.bincount(owner, self.byte.rest[letters], minlength=len(first) - 1)
        return place, path, unit, contexts, shares, hashes, symbol, first, units

    def plain_counts(self, seen: np.ndarray) -> np.ndarray:
        """How often each node decided 0 and 1, from how often each word and letter was met."""
        out = np.zeros(2 * self.nodes, dtype=np.int64)
        for low in range(0, len(seen), 1 << 15):  # some hundred thousand decisions at a time
            some, begin = seen[low : low + (1 << 15)], self.path_first[low]
            path = self.paths[begin : begin + self.path_size[low : low + (1 << 15)].sum()]
            np.add.at(out, path, np.repeat(some, self.path_size[low : low + (1 << 15)]))
        return out.reshape(-1, 2).T

    def _letters(self, words: Words, chosen: np.ndarray, topic: np.ndarray):
        """Bytes of the chosen words, each closed by 256, with their contexts."""
        start, end = words.starts[chosen], words.ends[chosen]
        size = end - start + 1
        first = np.concatenate([[0], np.cumsum(size)])
        ramp = np.arange(first[-1]) - np.repeat(first[:-1], size)
        at = np.repeat(start, size) + ramp
        closing = at == np.repeat(end, size)
        letters = np.where(closing, 256, words.data[np.minimum(at, len(words.data) - 1)] if len(words.data) else 256).astype(np.int64)
        before = []
        for back in (1, 2, 3):
            value = np.concatenate([np.zeros(min(back, len(letters)), np.int64), letters[:-back] + 1])[: len(letters)]
            before.append(np.where(ramp >= back, value, 0).astype(np.uint64))
        o1 = before[0]
        o2 = o1 | before[1] << np.uint64(9)
        o3 = o2 | before[2] << np.uint64(18)
        salt = np.uint64(1 << 40)
        return first, letters, [mix(o1 + salt), mix(o2 + salt * np.uint64(2)), mix(o3 + salt * np.uint64(3))]

    @property
    def nodes(self) -> int:
        return self.word.count + self.byte.count


def _slots(salt: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Slot of decisions in a hashed table, from their nodes' salt and their contexts."""
    value = context ^ salt
    value *= np.uint64(0xC2B2AE3D27D4EB4F)
    value >>= np.uint64(64 - (SLOTS - 1).bit_length())
    return value.view(np.int64)


def _shared(spark, coder_parts):
    """Broadcast arrays; each worker builds its coder once."""
    broadcast = spark.sparkContext.broadcast(coder_parts)
    return broadcast._jbroadcast.id(), broadcast


_loaded: dict = {}


def _coder(key: int, broadcast) -> Coder:
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Coder(*broadcast.value[:5])
    return _loaded[key]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, count) of tokens and, under negative keys, counts of bytes inside words and of words."""
    for batch in small_batches(batches, "text"):
        words = find_words(batch.column("text"), lower=True)
        hashes, _ = token_hashes(words)
        found, counts = np.unique(hashes, return_counts=True)
        bytes_ = np.bincount(words.data, minlength=256)
        bytes_[[0x20, 9, 10, 11, 12, 13]] = 0
        bytes_ = np.append(bytes_, len(words.starts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(len(found), bool), np.ones(257, bool)])),
             pa.array(np.concatenate([found.view(np.int64), np.arange(257)])), pa.array(np.concatenate([counts, bytes_]))],
            names=["byte", "hash", "count"],
        )


def _tally(coder: Coder, node, bit, unit, contexts, tables: np.ndarray) -> None:
    """Add a batch's decisions to the counts in contexts, in place: a batch asks for far fewer slots than there are."""
    _tally_path(node * 2 + bit, unit, contexts, tables)


def _tally_path(path: np.ndarray, unit: np.ndarray, contexts, tables: np.ndarray) -> None:
    one = np.ones((), dtype=tables.dtype)
    for low in range(0, len(path), _PART):
        part = slice(low, low + _PART)
        taken, who = path[part].astype(np.int64), unit[part].astype(np.int64)
        bit = taken & 1
        taken >>= 1
        salt = taken.view(np.uint64) * _NODE_SALT
        for table, context in zip(tables, contexts):
            slot = _slots(salt, context.take(who))
            slot <<= 1
            slot += bit
            np.add.at(table, slot, one)


def _count_contexts(key: int, broadcast, lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = _coder(key, broadcast)
        lane = TaskContext.get().partitionId() % lanes
        seen = np.zeros(len(coder.path_size), dtype=np.int64)  # of words and letters: their paths are counted at the end
        tables = np.zeros((_LANES - 1, 2 * SLOTS), dtype=np.uint32)
        some = False
        for batch in small_batches(batches, "text"):
            some = True
            _, *taken, _, _, _, _, units = coder.path(find_words(batch.column("text"), lower=True))
            _tally_path(*taken, tables)
            seen += np.bincount(units, minlength=len(seen))
        if not some:
            return
        plain = coder.plain_counts(seen).ravel()
        rows = [(-1, len(plain), _packed(plain))]
        for number, table in enumerate(tables):
            for at in range(0, 2 * SLOTS, 2 * CHUNK):
                part = table[at : at + 2 * CHUNK]
                if part.any():
                    rows.append((number * SLOTS // CHUNK + at // (2 * CHUNK), len(part), _packed(part)))
        for at in range(0, len(rows), 64):
            some_rows = rows[at : at + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some_rows], pa.int32()), pa.array([lane] * len(some_rows), pa.int32()),
                 pa.array([r[1] for r in some_rows], pa.int64()), pa.array([r[2] for r in some_rows], pa.binary())],
                names=["chunk", "lane", "counts", "data"],
            )

    return run


def _packed(counts: np.ndarray) -> bytes:
    """Counts compressed byte by byte of equal weight: most upper ones are 0."""
    return pa.compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 8 * count, "zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8")[:, 0]


def _add_up(frame: pd.DataFrame) -> pd.DataFrame:
    counts = int(frame["counts"].iloc[0])
    total = np.zeros(counts, dtype=np.int64)
    for data in frame["data"]:
        total += _unpacked(data, counts)
    return pd.DataFrame({"chunk": frame["chunk"][:1], "lane": frame["lane"][:1], "counts": [counts], "data": [_packed(total)]})


_SUMS = "chunk int, lane int, counts bigint, data binary"


def _bound(counts: DataFrame) -> int:
    """The smallest count of a vocabulary word, so that there are at most VOCABULARY of them."""
    step = F.floor(F.log2("count") * 4).cast("int")
    rows = counts.groupBy(step.alias("step")).count().collect()  # a step is a quarter of a doubling: a few hundred rows
    room, least = VOCABULARY, None
    for row in sorted(rows, key=lambda r: -r["step"]):
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    return least


def _lookups(plain: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """What a node tells without a context (both shares, weighted as counts), and the tables: a pair in one look-up."""
    total = plain[0] + plain[1] + 1
    shares = np.stack([(plain[0] + 0.5) / total, (plain[1] + 0.5) / total], 1).astype(np.float32)
    alone = (np.float32(_STRENGTH) * shares).view(np.complex64)[:, 0]
    # Copies, as numpy's own large arrays lie in large pages, unpickled ones do not: scattered look-ups are faster there.
    return alone, [np.array(t, dtype=np.float32, order="C").view(np.complex64)[:, 0] for t in tables]


def _predictions(coder: Coder, plain: np.ndarray, tables: np.ndarray, node: np.ndarray, unit: np.ndarray, contexts) -> tuple[np.ndarray, np.ndarray]:
    """Stretched predictions that a decision is 1, one row a predictor, and the gate."""
    inputs, gate = _predict(coder, *_lookups(plain, tables), node * 2, unit, contexts)
    return np.concatenate([pair.T for pair in inputs]), gate


def _predict(coder: Coder, alone, pairs, path: np.ndarray, unit: np.ndarray, contexts) -> tuple[list[np.ndarray], np.ndarray]:
    """The same from look-ups made once and paths, predictors in twos side by side. A few ten thousand decisions at a time stay in cache."""
    strength = np.float32(_STRENGTH)
    # Arrays of their own, as the allocator keeps arrays below 32 MB for the next batch.
    inputs = [np.empty((len(path), 2), dtype=np.float32) for _ in range(_LANES // 2)]
    gate = np.empty(len(path), dtype=np.uint8)
    for low in range(0, len(path), _PART):
        part = slice(low, low + _PART)
        at, who = path[part].astype(np.int64), unit[part].astype(np.int64)
        at >>= 1
        salt = at.view(np.uint64) * _NODE_SALT
        both = alone.take(at)
        np.divide(both.imag, both.real, out=inputs[0][part, 0])
        level = (at >= coder.word.count).view(np.uint8)
        for number, (table, context) in enumerate(zip(pairs, contexts)):
            # The counts, and the shorter context's prediction with the weight of a few of them.
            both += table.take(_slots(salt, context.take(who)))
            one, zero = both.imag, both.real
            np.divide(one, zero, out=inputs[(number + 1) // 2][part, (number + 1) % 2])
            total = one + zero
            if number:
                level <<= 2
                for limit in _CONFIDENCE:
                    level += (total > limit).view(np.uint8)
            if number < _LANES - 2:
                both *= strength / total  # not 1 - p for the other side, which may be nothing where counts are one-sided
        gate[part] = level
        for pair in inputs:
            np.log(pair[part], out=pair[part])
    return inputs, gate


@dataclass
class Steps:
    """The blocks of all texts, first blocks first, longest texts first: decision i of this order is ``source[i]`` of the
    batch, and its text is number ``spot[i] / _GATES`` of ``order``. ``texts`` and ``begin`` are those of the blocks, ``ends`` say where the first,
    second, ... blocks of all texts begin."""

    order: np.ndarray
    source: np.ndarray
    spot: np.ndarray
    texts: np.ndarray
    begin: np.ndarray
    ends: list[int]


def _steps(first: np.ndarray) -> Steps:
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    sizes, start = sizes[order], first[:-1][order]
    many = -(-sizes // BLOCK)
    texts, block = np.repeat(np.arange(len(sizes)), many), _ramp(many)
    sorted_ = np.argsort(block, kind="stable")
    texts, block = texts[sorted_], block[sorted_]
    length = np.minimum(BLOCK, sizes[texts] - block * BLOCK)
    places = np.concatenate([[0], np.cumsum(length)])
    source = np.repeat((start[texts] + block * BLOCK - places[:-1]).astype(np.int32), length)
    source += np.arange(len(source), dtype=np.int32)
    ends = places[np.searchsorted(block, np.arange(int(many.max(initial=0)) + 1))]
    return Steps(order, source, np.repeat((texts * _GATES).astype(np.int32), length), texts, places[:-1], ends.tolist())


def _mix_online(first: np.ndarray, bit: np.ndarray, inputs: np.ndarray, gate: np.ndarray, rate: float) -> np.ndarray:
    """log10 probability of each text's decisions, with weights that follow the error within the text."""
    steps = _steps(first)
    inputs = [np.ascontiguousarray(inputs[k : k + 2].T).take(steps.source, axis=0) for k in range(0, _LANES, 2)]
    return _mix(steps, bit.take(steps.source), inputs, gate.take(steps.source), rate)


def _mix(steps: Steps, bit: np.ndarray, inputs: list[np.ndarray], gate: np.ndarray, rate: float) -> np.ndarray:
    """The same of decisions in the order of their steps, predictors in twos; ``inputs`` are used up."""
    out = np.zeros(len(steps.order))
    if not len(bit):
        return out
    # Two weights are one complex number: looked up and added to at once.
    weights = np.repeat(np.array(START_WEIGHTS, dtype=np.float32).view(np.complex64)[:, None], len(out) * _GATES, axis=1)
    # Minus one for a decision of 1: by this sign a stretched prediction speaks against what happened.
    against = (1 - 2 * bit.astype(np.int8)).astype(np.float32)
    spots = steps.spot + gate
    loss = np.empty(len(bit), dtype=np.float32)
    low_end, high_end, rate = np.float32(-13), np.float32(13), np.float32(rate)
    for low, high in zip(steps.ends[:-1], steps.ends[1:]):
        spot, sign = spots[low:high].astype(np.int64), against[low:high]
        z = 0
        for pair, x in zip(weights, inputs):
            mine = pair.take(spot).view(np.float32)
            mine *= x[low:high].ravel()
            z = z + mine
        z = z[::2] + z[1::2]
        z *= sign
        # odds: how much likelier the other bit was.
        odds = np.exp(np.minimum(np.maximum(z, low_end, out=z), high_end, out=z), out=z)
        both = np.add(odds, 1, out=loss[low:high])
        error = odds
        error /= both
        error *= rate
        error *= sign
        for pair, x in zip(weights, inputs):
            move = x[low:high].view(np.complex64)[:, 0]
            move *= error
            np.subtract.at(pair, spot, move)
    np.log(loss, out=loss)
    out[steps.order] -= np.bincount(steps.texts, np.add.reduceat(loss, steps.begin, dtype=np.float64), minlength=len(out))
    return out / np.log(10)


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for every size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _score(key: int, broadcast, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, broadcast)
        _, counts, _, _, _, plain, tables, floor = broadcast.value
        shown = np.log10(np.append(counts, 0) + 1.0) - floor
        lookups = _lookups(plain, tables)
        for batch in small_batches(batches, "text"):
            words = find_words(batch.column("text"), lower=True)
            place, path, unit, contexts, shares, hashes, symbol, first, _ = coder.path(words)
            steps = _steps(place)
            path, unit = path.take(steps.source), unit.take(steps.source)
            inputs, gate = _predict(coder, *lookups, path, unit, contexts)
            score = shares.astype(np.float64) + _mix(steps, path & 1, inputs, gate, rate)
            texts = np.repeat(np.arange(batch.num_rows), np.diff(first))
            known = symbol != coder.escape
            base = np.bincount(texts[known], shown[symbol[known]], minlength=batch.num_rows).astype(np.float64)
            hits = np.bincount(texts[known], minlength=batch.num_rows)
            # Other tokens, per text and word, to be looked up.
            other_text, other = texts[~known], hashes[~known]
            order = np.lexsort((other, other_text))
            other_text, other = other_text[order], other[order]
            new = np.ones(len(other), dtype=bool)
            new[1:] = (other[1:] != other[:-1]) | (other_text[1:] != other_text[:-1])
            heads = np.flatnonzero(new)
            times = np.diff(np.append(heads, len(other)))
            places = np.searchsorted(other_text[heads], np.arange(batch.num_rows + 1)).astype(np.int32)
            rare = pa.ListArray.from_arrays(
                pa.array(places),
                pa.StructArray.from_arrays([pa.array(other[heads].view(np.int64)), pa.array(times)], names=["hash", "times"]),
            )
            lengths = np.diff(words.offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("id"), batch.column("held_out"), pa.array(np.diff(first)), pa.array(hits),
                 pa.array(base), pa.array(score), pa.array(lengths), rare],
                names=["uid", "id", "held_out", "n_tokens", "hits", "base", "score", "n_bytes", "rare"],
            )

    return run


_SCORED = (
    "uid bigint, id bigint, held_out boolean, n_tokens bigint, hits bigint, base double, score double, n_bytes bigint, "
    "rare array<struct<hash: bigint, times: bigint>>"
)


def score_texts(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", rate: float = 0.02,
    tree_depth: int | None = None,
) -> DataFrame:
    """Scores of all rows, from a model of those for which ``held_out`` is false.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigram), score (the model's log10
    probability) and bits_per_byte. A null or empty text is one end. Rows that occur twice count twice in training and
    are returned twice; ids may be null or repeat. A null ``held_out`` counts as false. With no training text the trees
    are uniform and base_score is 0. An empty table gives no rows.

    ``tree_depth`` ends the word tree after so many decisions; within its last intervals a word then has its share of
    the interval's count, whatever the context. None: single words."""
    spark = docs.sparkSession
    prepare(spark)
    keyed = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(f"`{text_column}`").alias("text"),
    )
    training = keyed.where(~F.col("held_out")).select("text")

    counted = training.mapInArrow(tidy(_count_words), "byte boolean, hash bigint, count bigint")
    counted = save(counted.groupBy("byte", "hash").agg(F.sum("count").alias("count")), "counts")
    counts = counted.where("not byte").select("hash", "count")
    totals = counts.agg(F.sum("count").alias("n"), F.count("*").alias("v")).collect()[0]
    total, distinct = int(totals["n"] or 0), int(totals["v"])
    byte_counts = np.zeros(257)
    for row in counted.where("byte").collect():  # 257 rows at most
        byte_counts[row["hash"]] = row["count"]
    least = _bound(counts)
    step = F.floor(F.log2("count") * 4).cast("int")
    top = counts.where(step >= least) if least is not None else counts.limit(0)
    chosen = top.toArrow()
    hashes, found = (chosen.column(c).to_numpy() for c in ("hash", "count"))
    order = np.lexsort((hashes, -found))
    parts = (np.ascontiguousarray(hashes[order]).view(np.uint64), found[order], total, byte_counts, tree_depth)

    lanes = max(1, int(training.rdd.getNumPartitions() ** 0.5))
    key, shared = _shared(spark, parts)
    summed = training.mapInArrow(tidy(_count_contexts(key, shared, lanes)), _SUMS)
    for group in (["chunk", "lane"], ["chunk"]):
        summed = summed.groupBy(*group).applyInPandas(_add_up, _SUMS)
    coder = Coder(*parts)
    plain, tables = np.zeros((2, coder.nodes)), np.zeros((_LANES - 1) * 2 * SLOTS, dtype=np.float32)
    gathered = save(summed, "contexts").toArrow()
    for chunk, counts_, data in zip(*(gathered.column(c).to_pylist() for c in ("chunk", "counts", "data"))):
        part = _unpacked(data, counts_)
        if chunk < 0:
            plain = part.reshape(2, -1).astype(np.float64)
        else:
            tables[chunk * 2 * CHUNK : (chunk + 1) * 2 * CHUNK] = part
    floor = float(np.log10(total + (distinct + 1)))
    key, shared = _shared(spark, (*parts, plain, tables.reshape(_LANES - 1, SLOTS, 2), floor))
    scored = save(keyed.mapInArrow(tidy(_score(key, shared, rate)), _SCORED), "scored")

    rare = scored.select("uid", F.explode("rare").alias("r")).select("uid", "r.hash", "r.times")
    looked = rare.join(counts, "hash", "left").select(
        "uid", F.when(F.col("count") > 0, F.col("times")).otherwise(0).alias("hits"),
        (F.col("times") * (F.log10(F.coalesce("count", F.lit(0)) + 1.0) - F.lit(floor))).alias("base"),
    )
    looked = save(looked.groupBy("uid").agg(F.sum("hits").alias("more_hits"), F.sum("base").alias("more_base")), "rare")
    joined = scored.drop("rare").join(looked, "uid", "left")
    return joined.select(
        "id", "held_out", "n_tokens", (F.col("hits") + F.coalesce("more_hits", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score", (-F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
