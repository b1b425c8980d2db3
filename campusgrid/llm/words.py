"""Words of whole Arrow batches as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D. Those bytes never occur inside a multi-byte
UTF-8 character, so splitting bytes splits characters correctly. All functions work on a batch of texts at once:
``Words`` holds where each word starts and ends in the joined bytes, and which words belong to which text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Odd multipliers of the rolling hashes; any odd numbers do.
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        have = _powers[base] = tuple(tables)
    return have


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _WORD_BASE) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span, from one running sum."""
    up, down = _power_tables(base, len(values) + 1)
    running = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=running[1:])
    return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """``first[i]:first[i + 1]`` are the words of text i; ``data`` are the joined bytes, ``offsets`` the texts in them."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, _BYTE_BASE)

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of each text's (kept) words joined by one space."""
        index = np.arange(len(self.starts)) if keep is None else np.flatnonzero(keep)
        starts, ends, owner = self.starts[index], self.ends[index], self.owner[index]
        lengths = ends - starts + 1
        at = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])
        out = self.data[np.minimum(source, len(self.data) - 1)] if len(self.data) else np.zeros(0, np.uint8)
        closing = at[1:] - 1
        out[closing] = 0x20
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        used = np.ones(len(out), dtype=bool)
        used[closing[last]] = False
        sizes = np.zeros(len(self.first) - 1, dtype=np.int64)
        np.add.at(sizes, owner, lengths)
        sizes[sizes > 0] -= 1
        return out[used], np.concatenate([[0], np.cumsum(sizes)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Joined bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    joined = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return joined[places[0] : places[-1]], places - places[0]


def find_words(column: pa.Array, lower: bool = False, breaks: np.ndarray = _SPACE) -> Words:
    """``breaks`` marks the bytes that no word holds."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def string_column(data: np.ndarray, offsets: np.ndarray, kind=pa.string()) -> pa.Array:
    wide = pa.large_string() if kind == pa.string() else pa.large_binary()
    parts = [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(wide, len(offsets) - 1, parts).cast(kind)


def small_batches(batches: Iterable[pa.RecordBatch], text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, alike in size (a longer text makes a batch of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            left = int(offsets[-1] - offsets[at])
            share = -(-left // max(1, -(-left // limit)))
            to = int(np.searchsorted(offsets, offsets[at] + share, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
