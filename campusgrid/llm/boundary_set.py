"""Compressed sets of increasing whole numbers, searched by rank.

Numbers are kept in containers by their bits above the lowest 16. A container is a sorted array of the low bits, a
bitmap of 2^16 bits, or a list of runs, whichever is smallest; cumulative cardinalities of the containers lead to the
container that holds the k-th number, and a local select finds it there."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

ARRAY, BITMAP, RUN = 0, 1, 2
_BITMAP_BYTES = 1 << 13
_HEAD = struct.Struct("<I")
_BITS = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


@dataclass(frozen=True)
class BoundarySet:
    """``ranks[i]`` numbers lie in containers before the i-th; ``ranks[-1]`` is the size of the set."""

    keys: np.ndarray
    kinds: np.ndarray
    ranks: np.ndarray
    places: np.ndarray
    data: bytes

    def __len__(self) -> int:
        return int(self.ranks[-1])

    @classmethod
    def of(cls, values: np.ndarray) -> BoundarySet:
        """From strictly increasing numbers in [0, 2^48)."""
        high = values >> 16
        first = np.flatnonzero(np.diff(high, prepend=-1)) if len(values) else np.zeros(0, np.int64)
        ranks = np.append(first, len(values))
        kinds, parts = [], []
        for a, b in zip(ranks[:-1].tolist(), ranks[1:].tolist()):
            kind, part = _contained((values[a:b] & 0xFFFF).astype(np.int64))
            kinds.append(kind)
            parts.append(part)
        places = np.cumsum([0, *map(len, parts)])
        return cls(high[first].astype(np.uint32), np.array(kinds, np.uint8), ranks.astype(np.int64), places.astype(np.int64), b"".join(parts))

    def select(self, k: int) -> int:
        """The k-th number, counted from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        i = int(np.searchsorted(self.ranks, k, side="right")) - 1
        part = self.data[self.places[i] : self.places[i + 1]]
        return (int(self.keys[i]) << 16) + _LOCAL[int(self.kinds[i])](part, k - int(self.ranks[i]))

    def to_bytes(self) -> bytes:
        heads = (self.keys.astype("<u4"), self.kinds, self.ranks[1:].astype("<i8"), self.places[1:].astype("<i8"))
        return _HEAD.pack(len(self.keys)) + b"".join(h.tobytes() for h in heads) + self.data

    @classmethod
    def from_bytes(cls, raw: bytes) -> BoundarySet:
        (n,) = _HEAD.unpack_from(raw)
        at, heads = _HEAD.size, []
        for kind in ("<u4", "u1", "<i8", "<i8"):
            heads.append(np.frombuffer(raw, kind, n, at))
            at += heads[-1].nbytes
        whole = lambda ends: np.concatenate([[0], ends]).astype(np.int64)
        return cls(heads[0], heads[1], whole(heads[2]), whole(heads[3]), raw[at:])


def _contained(low: np.ndarray) -> tuple[int, bytes]:
    """The smallest of the three forms of one container."""
    breaks = np.flatnonzero(np.diff(low) != 1)
    sizes = {ARRAY: 2 * len(low), BITMAP: _BITMAP_BYTES, RUN: 4 * (len(breaks) + 1)}
    kind = min(sizes, key=sizes.__getitem__)
    if kind == ARRAY:
        return kind, low.astype("<u2").tobytes()
    if kind == BITMAP:
        bits = np.zeros(1 << 16, dtype=np.uint8)
        bits[low] = 1
        return kind, np.packbits(bits, bitorder="little").tobytes()
    starts = low[np.append(0, breaks + 1)]
    longer = low[np.append(breaks, len(low) - 1)] - starts  # a run's length less one, so that 2^16 fits
    return kind, np.column_stack([starts, longer]).astype("<u2").tobytes()


def _in_array(part: bytes, k: int) -> int:
    return int.from_bytes(part[2 * k : 2 * k + 2], "little")


def _in_bitmap(part: bytes, k: int) -> int:
    bits = np.frombuffer(part, np.uint8)
    counts = np.cumsum(_BITS[bits])
    at = int(np.searchsorted(counts, k, side="right"))
    before = int(counts[at - 1]) if at else 0
    within = np.flatnonzero(np.unpackbits(bits[at : at + 1], bitorder="little"))
    return 8 * at + int(within[k - before])


def _in_runs(part: bytes, k: int) -> int:
    runs = np.frombuffer(part, "<u2").reshape(-1, 2).astype(np.int64)
    ends = np.cumsum(runs[:, 1] + 1)
    at = int(np.searchsorted(ends, k, side="right"))
    before = int(ends[at - 1]) if at else 0
    return int(runs[at, 0]) + k - before


_LOCAL = {ARRAY: _in_array, BITMAP: _in_bitmap, RUN: _in_runs}
