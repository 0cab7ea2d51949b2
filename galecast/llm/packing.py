"""Packing documents into sequences by bin completion with best-fit incumbents.

Pieces are dealt into shards of bounded size by a hash, and every shard is
packed for itself: best-fit decreasing gives an incumbent; if it is above the
lower bound, branch and bound fills one bin at a time around the largest piece
left, trying only fillings that no other filling dominates, and turns back
when the waste so far rules out a better packing. The least filled sequences
of the shards are then packed together, so a shard costs no sequence of its own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.llm.session import ready, written
from galecast.llm.textblocks import text_blocks
from galecast.llm.tokens import REMEMBERED, encoder

CAPACITY = 4096
SHARD_DOCS = 8192
TAIL_SHARDS = 512
SEARCH_STEPS = 20_000
OPEN_FILLINGS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long, tail boolean"
_PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())
])


class _Sizes:
    """A multiset of sizes with a bitmap of those present, for the largest one up to a limit."""

    def __init__(self, lengths: list[int]):
        self.count: dict[int, int] = defaultdict(int)
        self.present = 0
        for n in lengths:
            self.add(n)

    def add(self, n: int) -> None:
        self.count[n] += 1
        self.present |= 1 << n

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.present &= ~(1 << n)

    def largest(self, limit: int) -> int:
        return (self.present & ((2 << limit) - 1)).bit_length() - 1 if limit > 0 else -1


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    for n in sorted(lengths, reverse=True):
        fitting = rooms >> n
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + n
            k = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(n)
        if room > n:
            by_room[room - n].append(k)
            rooms |= 1 << (room - n)
    return bins


def _spread(bits: int, width: int) -> int:
    """Every set bit and the ``width`` bits above it."""
    have = 0
    while have < width:
        step = min(have + 1, width - have)
        bits |= bits << step
        have += step
    return bits


def _dominated(filling: tuple[int, ...], room: int, sizes: _Sizes) -> bool:
    """Whether a piece left outside fits as well, or in place of a smaller one or of several whose sum is no larger."""
    slack = room - sum(filling)
    outside = sizes.present
    for n in set(filling):
        if sizes.count[n] == filling.count(n):
            outside &= ~(1 << n)
    if outside & ((2 << slack) - 1):
        return True
    one = several = 0  # sums of one piece of the filling, of two or more
    for n in filling:
        several |= (several | one) << n
        one |= 1 << n
    larger = _spread(one << 1, slack - 1) if slack else 0
    return bool(outside & (larger | _spread(several, slack)))


def undominated_fillings(sizes: _Sizes, room: int) -> Iterator[tuple[int, ...] | None]:
    """All ways to fill ``room`` that no other way dominates, fullest first, larger pieces first; None for each one left out.

    Sums that the smaller sizes reach are known for every size, so the walk
    from the largest size down has no dead end. ``sizes`` must be as at the
    start whenever the next one is asked for.
    """
    top = sizes.largest(room)
    if top <= 0:
        yield ()
        return
    if top == room:
        yield (top,)
        return
    found, reached, left = [], [1], sizes.present & ((2 << room) - 1)
    limit = (2 << room) - 1
    while left:
        n = (left & -left).bit_length() - 1
        left &= left - 1
        sums, copies, step = reached[-1], min(sizes.count[n], room // n), 1
        while copies:
            step = min(step, copies)
            sums |= (sums << n * step) & limit
            copies -= step
            step *= 2
        found.append(n)
        reached.append(sums)

    def ways(i: int, rest: int) -> Iterator[tuple[int, ...]]:
        """Of the first ``i`` sizes, with sum ``rest``."""
        if not rest:
            yield ()
            return
        while i:
            n = found[i - 1]
            below = reached[i - 1]
            for copies in range(min(sizes.count[n], rest // n), 0, -1):
                if below >> (rest - n * copies) & 1:
                    for more in ways(i - 1, rest - n * copies):
                        yield (n,) * copies + more
            if not below >> rest & 1:
                return
            i -= 1

    sums = reached[-1]
    while sums > 1:
        total = sums.bit_length() - 1
        sums ^= 1 << total
        for filling in ways(len(found), total):
            yield None if _dominated(filling, room, sizes) else filling


def bin_completion(lengths: list[int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Few bins of ``capacity`` for ``lengths``; the fewest unless ``steps`` run out, then the best found.

    A step is a filling looked at, dominated ones included, or a turn back.
    """
    best = best_fit(lengths, capacity)
    total = sum(lengths)
    bound = -(-total // capacity)
    sizes = _Sizes(lengths)
    # Per bin: its largest piece, the fillings to come (None: dropped to save memory), how many were looked at.
    path: list[list] = []
    bins: list[list[int]] = []
    waste = 0

    def undo() -> None:
        nonlocal waste
        last = bins.pop()
        waste -= capacity - sum(last)
        for n in last:
            sizes.add(n)

    def next_filling() -> tuple[int, ...] | None:
        """The next filling of the last bin of the path; None where there is no other."""
        nonlocal steps
        level = path[-1]
        sizes.take(level[0])
        if level[1] is None:
            level[1] = islice(undominated_fillings(sizes, capacity - level[0]), level[2], None)
        filling = None
        for filling in level[1]:
            level[2] += 1
            steps -= 1
            if filling is not None or steps <= 0:
                break
        sizes.add(level[0])
        return filling

    while len(best) > bound and steps > 0:
        top = sizes.largest(capacity)
        if top <= 0:
            best = [list(b) for b in bins]
        elif waste <= (len(best) - 1) * capacity - total:
            path.append([top, None, 0])
            if len(path) > OPEN_FILLINGS:
                path[-1 - OPEN_FILLINGS][1] = None
        filling = next_filling() if len(path) > len(bins) else None
        while filling is None and steps > 0:
            steps -= 1
            if len(path) > len(bins):
                path.pop()
            if not path:
                return best
            undo()
            filling = next_filling()
        if filling is None:
            break
        for n in (path[-1][0], *filling):
            sizes.take(n)
        bins.append([path[-1][0], *filling])
        waste += capacity - sum(bins[-1])
    return best


def _pack_shard(capacity: int, steps: int, tail_round: bool):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        waiting: dict[int, list[int]] = defaultdict(list)
        for i in range(len(rows) - 1, -1, -1):
            waiting[int(lengths[i])].append(i)
        bins = bin_completion(lengths.tolist(), capacity, steps)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        fill = np.array([sum(b) for b in bins])
        for k, content in enumerate(bins):
            at = 0
            for n in content:
                i = waiting[n].pop()
                sequence[i], offset[i] = k, at
                at += n
        tail = np.zeros(len(rows), bool)
        if not tail_round and len(bins):
            tail = sequence == int(fill.argmin())
        number = (int(key[0]) << 32) | sequence
        return rows.assign(sequence_id=-1 - number if tail_round else number, offset=offset, tail=tail)[[c.split()[0] for c in PLACED.split(", ")]]

    return pack


def _piece_maker(tokenizer: str, end_id: int, capacity: int, remembered: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False, remembered).encode
        for batch, data, off in text_blocks(batches):
            ids, ends = encode(data, off, end_id)
            ids = ids.astype("<u4")
            pieces = -(-np.diff(ends) // capacity)
            doc = np.repeat(np.arange(len(pieces)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, np.diff(ends)[doc] - start)
            first = ends[doc] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                schema=_PIECES_ARROW,
            )

    return cut


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all documents; null text is empty and has the end id alone.

    A worker remembers the ids of at most twice ``remembered`` chunks.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_piece_maker(tokenizer, end_id, capacity, remembered), PIECES)


def pack(found: DataFrame, n_docs: int, capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> DataFrame:
    """Places pieces (doc_id, piece, start, length, ids_crc32); adds sequence_id and offset.

    No piece is longer than ``capacity``. Equal rows are placed one after
    another. No rows give no sequences.
    """
    shards = max(1, -(-n_docs // SHARD_DOCS))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int")
    first = written(found.groupBy(shard.alias("shard")).applyInPandas(_pack_shard(capacity, steps, False), PLACED), "packed")
    again = F.shiftright("sequence_id", 32) / F.lit(TAIL_SHARDS)
    tails = (
        first.where("tail").groupBy(F.floor(again).cast("int").alias("shard"))
        .applyInPandas(lambda key, rows: _pack_shard(capacity, steps, True)(key, rows.drop(columns=["sequence_id", "offset", "tail"])), PLACED)
    )
    return first.where("not tail").unionByName(tails).drop("tail")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, remembered: int = REMEMBERED
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for all pieces of all documents."""
    return pack(pieces(docs, tokenizer, end_id, capacity, remembered), docs.count(), capacity)
