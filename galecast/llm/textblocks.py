"""Texts as byte arrays: blocks of rows, words in them, and 64-bit hashes of words.

Everything works on whole blocks with numpy, without a Python object per word.
A word is ``[^\\x20\\x09-\\x0D]+``; bytes of other characters are never white space.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
BLOCK_ROWS = 4096

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20_25).integers(1, 1 << 63, 256, dtype=np.uint64)
_folded = np.arange(256)
_folded[ord("A") : ord("Z") + 1] += 32
LOWER_VALUES = BYTE_VALUES[_folded]
_powers: dict[int, np.ndarray] = {}


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_blocks(
    batches: Iterable[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES, rows: int = BLOCK_ROWS
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with their bytes and offsets, about ``size`` bytes and ``rows`` rows at a time; a longer text is a block of its own.

    With the last block the worker, which stays for later tasks, gives back what it does not need.
    """
    for batch in batches:
        data, off = text_buffers(batch.column(text))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + size, "right")) - 1
            j = min(max(j, i + 1), i + rows, n)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j
        del data, off, batch
    give_back()


def give_back() -> None:
    """Free memory that this process holds but does not use goes back to the system."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another libc
        pass


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, in order."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SPACE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
        if n > BLOCK_BYTES + 1:
            del _powers[base]  # of one very long text; not kept
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Polynomial hashes of byte spans modulo 2**64, from one running sum over the block."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * _power_table(_FACTOR, n + 1)[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power_table(_INVERSE, n + 1)[starts]
    return mixed(h + (ends - starts).astype(np.uint64))
