"""A set of positions with fast select, in containers of 2**16 positions each.

As in Roaring bitmaps a container holds the low 16 bits of its positions in
whichever of three forms is smallest: a sorted array, a bitmap, or runs
(first, length). Cumulative cardinalities say in which container the k-th
position lies; within it the array is indexed, the bitmap is searched by the
cumulative number of bits of its words, the runs by their cumulative lengths.
All selects of a call are answered together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPAN = 1 << 16
WORD_BITS = 64
BITMAP_BYTES = SPAN // 8
_BIT = np.arange(WORD_BITS, dtype=np.uint64)


@dataclass(frozen=True)
class ArrayContainer:
    values: np.ndarray  # uint16, sorted

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.values[k].astype(np.int64)


@dataclass(frozen=True)
class RunContainer:
    firsts: np.ndarray  # uint16
    before: np.ndarray  # positions in the runs before each run

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, "right") - 1
        return self.firsts[run].astype(np.int64) + k - self.before[run]


@dataclass(frozen=True)
class BitmapContainer:
    words: np.ndarray  # 1024 of uint64
    before: np.ndarray  # bits in the words before each word

    def select(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, k, "right") - 1
        bits = (self.words[word][:, None] >> _BIT & np.uint64(1)).astype(np.int8)
        wanted = (k - self.before[word] + 1)[:, None]
        return word * WORD_BITS + (np.cumsum(bits, axis=1, dtype=np.int16) >= wanted).argmax(axis=1)


def container(low: np.ndarray) -> ArrayContainer | RunContainer | BitmapContainer:
    """The smallest form for sorted, distinct 16-bit positions; at least one."""
    opens = np.flatnonzero(np.concatenate([[True], np.diff(low.astype(np.int32)) > 1]))
    if 4 * len(opens) < min(2 * len(low), BITMAP_BYTES):
        return RunContainer(low[opens], opens)
    if 2 * len(low) <= BITMAP_BYTES:
        return ArrayContainer(low)
    bits = np.zeros(SPAN, np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    counts = np.add.reduceat(bits, np.arange(0, SPAN, WORD_BITS), dtype=np.int64)
    return BitmapContainer(words, np.cumsum(counts) - counts)


class BoundarySet:
    """Sorted, distinct, non-negative positions."""

    def __init__(self, positions: np.ndarray):
        high = positions >> 16
        opens = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]])) if len(positions) else np.zeros(0, np.int64)
        self.keys = high[opens]
        self.cumulative = np.append(opens, len(positions))  # positions in the containers before each, and all
        low = (positions & (SPAN - 1)).astype(np.uint16)
        self.containers = [container(low[a:b]) for a, b in zip(self.cumulative[:-1], self.cumulative[1:])]

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, k: np.ndarray) -> np.ndarray:
        """The k-th positions, from 0; every k is below the size of the set."""
        k = np.asarray(k, np.int64)
        order = np.argsort(k, kind="stable")
        ranked = k[order]
        at = np.searchsorted(self.cumulative, ranked, "right") - 1
        found = np.zeros(len(k), np.int64)
        edges = np.searchsorted(at, np.arange(len(self.containers) + 1))
        for c, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a < b:
                found[a:b] = self.containers[c].select(ranked[a:b] - self.cumulative[c]) + (self.keys[c] << 16)
        out = np.empty_like(found)
        out[order] = found
        return out
