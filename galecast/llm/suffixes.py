"""Repeated passages, by suffixes sorted bucket by bucket with a difference cover.

A suffix counts up to its first ``WINDOW`` bytes here, so what is sorted are
windows. Sorting all of them would ship many times the corpus. The cover thins
them out: of the offsets 0..12 modulo 13, those of ``COVER`` are sampled, and
for any two places there is one shift below 13 that brings both to a sampled
offset. So two equal windows of 50 bytes always hold equal sampled strings of
38 bytes at the same shift.

1. Texts are stored once in blocks, bucketed by block, so that what is found
   out about a block meets its texts without moving them.
2. The sampled strings of every block are named by hash, dealt by ranges of
   names, and each range is sorted: which names occur in several blocks?
3. Only windows over a sampled string that occurs in several texts can repeat.
   They are named by 64-bit hashes and dealt by ranges; each range is sorted one
   bucket of bounded size at a time, and the smallest document of every run of
   equal names decides which windows are repeats.
4. Every block marks the bytes of its repeated windows.

Names stand for ranks: only whether two strings are equal matters, and ranks in
byte order would need the strings themselves, about twelve times the corpus.
Texts that equal one of a smaller id are repeats as a whole and take no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.llm import textblocks
from galecast.llm.session import fresh_path, ready, written
from galecast.llm.textblocks import BYTE_VALUES, mixed, text_blocks

WINDOW = 50
COVER, PERIOD = (0, 1, 3, 9), 13  # differences of the cover give every number modulo the period
SPARE_BITS = 8
ENTRIES_PER_RANGE = 1 << 23
ENTRIES_AT_ONCE = 1 << 21
NO_ID = (1 << 63) - 1
BLOCKS = "block long, ids array<long>, keys array<binary>, lengths array<long>, texts binary"
MESSAGES = "block long, bucket int, kind int, payload binary"
RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"
COPIES, SEEN, CANDIDATES, REPEATED = range(4)  # kinds of message
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept", pa.binary()),
])


def packed(numbers: np.ndarray) -> bytes:
    """Sorted unsigned numbers as compressed byte planes of their differences."""
    steps = np.diff(numbers.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def _flags(payload: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8), count=n).astype(bool)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of 64-bit names."""
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class Block:
    """Texts side by side; ``taking_part`` says which are compared with others."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, ids: np.ndarray, taking_part: np.ndarray):
        self.data, self.lengths, self.ids = data, lengths, ids
        self.off = np.concatenate([[0], np.cumsum(lengths)])
        self.row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.taking_part = taking_part
        n = len(data)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * textblocks._power_table(textblocks._FACTOR, n + 1)[:n], out=self._sums[1:])

    def names(self, at: np.ndarray, length: int) -> np.ndarray:
        """64-bit names of the strings of ``length`` bytes at ``at``."""
        scale = textblocks._power_table(textblocks._INVERSE, len(self.data) + 1)[at]
        return mixed((self._sums[at + length] - self._sums[at]) * scale + np.uint64(length))

    def _starts(self, length: int) -> np.ndarray:
        """Whether a string of ``length`` bytes of a text taking part starts at each byte."""
        good = np.repeat(self.taking_part, self.lengths)
        for k in range(1, length):
            ends = self.off[1:] - k
            good[ends[self.lengths >= k]] = False
        return good

    def sampled(self, window: int) -> np.ndarray:
        """Places of the cover at which a sampled string starts."""
        good = self._starts(window - PERIOD + 1)
        phase = np.arange(len(self.data), dtype=np.int32) - self.off[:-1].astype(np.int32)[self.row]
        in_cover = np.zeros(PERIOD, bool)
        in_cover[list(COVER)] = True
        return np.flatnonzero(good & in_cover[phase % PERIOD])

    def candidates(self, flagged: np.ndarray, window: int) -> np.ndarray:
        """Starts of windows that hold a flagged sampled string."""
        n = len(self.data)
        hits = np.zeros(n + PERIOD + 1, np.int32)
        hits[flagged + 1] = 1
        np.cumsum(hits, out=hits)
        return np.flatnonzero(self._starts(window) & (hits[PERIOD : n + PERIOD] > hits[:n]))


def distinct_names(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, whether each is in several rows, and the place of each given name among them."""
    order = np.argsort(names)
    ranked = names[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(names) else np.zeros(0, bool)
    place = np.empty(len(names), np.int64)
    place[order] = np.cumsum(first) - 1
    opens = np.flatnonzero(first)
    rows = row[order]
    several = np.minimum.reduceat(rows, opens) != np.maximum.reduceat(rows, opens) if len(opens) else np.zeros(0, bool)
    return ranked[opens], several, place


def _block_of(row: pd.Series, messages: pd.DataFrame) -> Block:
    lengths, ids = np.asarray(row["lengths"], np.int64), np.asarray(row["ids"], np.int64)
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["texts"]), np.uint8) if lengths.sum() else np.zeros(0, np.uint8)
    taking_part = np.ones(len(lengths), bool)
    for payload in messages.loc[messages["kind"] == COPIES, "payload"]:
        taking_part[np.frombuffer(payload, "<u4")] = False
    return Block(data, lengths, ids, taking_part)


def _short_names(block: Block, window: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of sampled strings, their distinct names of ``bits`` bits (low bits 0), several, place among them."""
    at = block.sampled(window)
    keep = ~np.uint64((1 << (64 - bits)) - 1)
    return at, *distinct_names(block.names(at, window - PERIOD + 1) & keep, block.row[at])


def _by_bucket(names: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    edges = np.searchsorted(bucket_of(names, buckets), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(int(edges[b]), int(edges[b + 1]))


def _sample_names(window: int, bits: int, buckets: int):
    def run(stored: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in stored.iterrows():
            _, names, _, _ = _short_names(_block_of(row, messages), window, bits)
            out += [(row["block"], b, SEEN, packed(names[part] >> np.uint64(64 - bits))) for b, part in _by_bucket(names, buckets)]
        return pd.DataFrame(out, columns=["block", "bucket", "kind", "payload"])

    return run


def _in_turn(names: list[np.ndarray]) -> Iterator[list[slice]]:
    """Slices of every sorted list, bucket by bucket of names, each of bounded size but for equal names."""
    total = sum(map(len, names))
    steps = max(1, -(-total // ENTRIES_AT_ONCE))
    everything = np.concatenate([x[:: max(1, len(x) // 64)] for x in names])
    edges = np.quantile(everything, np.linspace(0, 1, steps + 1)[1:-1], method="lower") if steps > 1 else np.zeros(0, np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]).astype(int) for x in names]
    for k in range(steps):
        yield [slice(c[k], c[k + 1]) for c in cuts]


def _names_in_several_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    names = [unpacked(p) for p in rows["payload"]]
    found = [np.zeros(len(x), bool) for x in names]
    for parts in _in_turn(names):
        joined = np.concatenate([x[p] for x, p in zip(names, parts)])
        order = np.argsort(joined)
        ranked = joined[order]
        same = ranked[1:] == ranked[:-1]
        flags = np.zeros(len(joined), bool)
        flags[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(joined) else False
        at = 0
        for f, p in zip(found, parts):
            f[p] = flags[at : at + p.stop - p.start]
            at += p.stop - p.start
    return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "kind": SEEN, "payload": [_bits(f) for f in found]})


def _window_names(window: int, bits: int, buckets: int, more_buckets: int):
    def run(stored: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in stored.iterrows():
            block = _block_of(row, messages)
            at, names, several, place = _short_names(block, window, bits)
            answers = {int(b): p for b, p, k in zip(messages["bucket"], messages["payload"], messages["kind"]) if k == SEEN}
            for b, part in _by_bucket(names, buckets):
                several[part] |= _flags(answers[b], part.stop - part.start)
            starts = block.candidates(at[several[place]], window)
            if not len(starts):
                continue
            out.append((row["block"], int(row["block"] % more_buckets), CANDIDATES, packed(starts)))
            names, least = smallest_ids(block, starts, window)[:2]
            for b, part in _by_bucket(names, more_buckets):
                ids, which = np.unique(least[part], return_inverse=True)
                planes = np.ascontiguousarray(which.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
                pieces = [packed(names[part]), packed(ids.astype(np.uint64)), zstandard.ZstdCompressor(level=1).compress(planes)]
                sizes = np.array([len(p) for p in pieces[:2]], "<u4").tobytes()
                out.append((row["block"], b, REPEATED, sizes + b"".join(pieces)))
        return pd.DataFrame(out, columns=["block", "bucket", "kind", "payload"])

    return run


def smallest_ids(block: Block, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names of windows, the smallest id of each, and the place of each window among them."""
    names, _, place = distinct_names(block.names(starts, window), block.row[starts])
    least = np.full(len(names), NO_ID, np.int64)
    np.minimum.at(least, place, block.ids[block.row[starts]])
    return names, least, place


def _opened(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Names and ids of a message of windows."""
    a, b = np.frombuffer(payload[:8], "<u4").tolist()
    names, ids = unpacked(payload[8 : 8 + a]), unpacked(payload[8 + a : 8 + a + b]).astype(np.int64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[8 + a + b :]), np.uint8).reshape(4, -1)
    return names, ids[np.ascontiguousarray(planes.T).view("<u4").reshape(-1)]


def _windows_of_smaller_ids(rows: pd.DataFrame) -> pd.DataFrame:
    passed = rows[rows["kind"] == CANDIDATES]
    rows = rows[rows["kind"] == REPEATED]
    opened = [_opened(p) for p in rows["payload"]]
    names, ids = [x for x, _ in opened], [y for _, y in opened]
    found = [np.zeros(len(x), bool) for x in names]
    for parts in _in_turn(names) if names else ():
        joined = np.concatenate([x[p] for x, p in zip(names, parts)])
        if not len(joined):
            continue
        each = np.concatenate([y[p] for y, p in zip(ids, parts)])
        order = np.argsort(joined)
        ranked = joined[order]
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        least = np.minimum.reduceat(each[order], np.flatnonzero(first))[np.cumsum(first) - 1]
        flags = np.empty(len(joined), bool)
        flags[order] = least < each[order]
        at = 0
        for f, p in zip(found, parts):
            f[p] = flags[at : at + p.stop - p.start]
            at += p.stop - p.start
    answers = pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "kind": REPEATED, "payload": [_bits(f) for f in found]})
    return pd.concat([passed, answers])[["block", "bucket", "kind", "payload"]]


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` bytes lie in a window that starts at one of ``starts``."""
    steps = np.zeros(n + 1, np.int32)
    steps[starts] = 1
    np.subtract.at(steps, np.minimum(starts + window, n), 1)
    return np.cumsum(steps[:n]) > 0


def _marked(window: int, buckets: int):
    def run(stored: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in stored.iterrows():
            block = _block_of(row, messages)
            n = len(block.data)
            gone = np.repeat(~block.taking_part & (block.lengths >= window), block.lengths)
            for payload in messages.loc[messages["kind"] == CANDIDATES, "payload"]:
                starts = unpacked(payload).astype(np.int64)
                names, least, place = smallest_ids(block, starts, window)
                smaller = np.zeros(len(names), bool)
                answers = {int(b): p for b, p, k in zip(messages["bucket"], messages["payload"], messages["kind"]) if k == REPEATED}
                for b, part in _by_bucket(names, buckets):
                    smaller[part] = _flags(answers[b], part.stop - part.start)
                repeats = smaller[place] | (least[place] < block.ids[block.row[starts]])
                gone |= covered(starts[repeats], n, window)
            opens, closes = gone.copy(), gone.copy()
            opens[1:] &= ~gone[:-1] | (block.row[1:] != block.row[:-1])
            closes[:-1] &= ~gone[1:] | (block.row[1:] != block.row[:-1])
            a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            first = np.searchsorted(a, block.off)
            raw = block.data.tobytes()
            for i, (lo, hi) in enumerate(zip(block.off[:-1].tolist(), block.off[1:].tolist())):
                spans = [(x - lo, y - x) for x, y in zip(a[first[i] : first[i + 1]].tolist(), b[first[i] : first[i + 1]].tolist())]
                kept, at = [], lo
                for start, length in spans:
                    kept.append(raw[at : lo + start])
                    at = lo + start + length
                kept.append(raw[at:hi])
                doc_id = None if block.ids[i] == NO_ID else int(block.ids[i])
                out.append((doc_id, hi - lo, [{"start": s, "length": m} for s, m in spans], b"".join(kept)))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _RESULT_ARROW)], schema=_RESULT_ARROW)

    return run


def _store_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    press = zstandard.ZstdCompressor(level=3)
    for batch, data, off in text_blocks(batches):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                pa.array([batch.column("key").to_pylist()], pa.list_(pa.binary())),
                pa.array([np.diff(off).tolist()], pa.list_(pa.int64())), pa.array([press.compress(data.tobytes())], pa.binary()),
            ],
            names=["block", "ids", "keys", "lengths", "texts"],
        )
        number += 1


def _stored_blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The blocks of all texts, bucketed by their number: a join on it moves no text."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.unhex(F.sha2(content, 256)).alias("key"), content.alias("text")
    )
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = rows.mapInArrow(_store_blocks, BLOCKS)
    made.write.bucketBy(buckets, "block").option("path", fresh_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def _copies(blocks: DataFrame) -> DataFrame:
    """Messages to blocks about their texts that equal one of a smaller id."""
    rows = written(
        blocks.select("block", F.posexplode(F.arrays_zip("ids", "keys")).alias("slot", "x")).select(
            "block", "slot", F.col("x.ids").alias("id"), F.col("x.keys").alias("key")
        ), "texts"
    )
    firsts = written(
        rows.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
        .select(F.col("key").alias("_key"), "first"), "firsts"
    )
    found = rows.join(firsts, F.col("key") == F.col("_key")).where("id > first")
    slots = found.groupBy("block").agg(F.collect_list("slot").alias("slots"))  # at most the rows of a block
    return slots.groupBy("block").applyInPandas(
        lambda rows: pd.DataFrame({
            "block": rows["block"], "bucket": -1, "kind": COPIES, "payload": [np.asarray(s, "<u4").tobytes() for s in rows["slots"]],
        }), MESSAGES,
    )


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, spans, kept: one row per row of ``docs``.

    ``spans`` are the maximal runs (start, length) of bytes of the UTF-8 text
    that lie in a string of ``window`` bytes which also starts in a document of
    a smaller id; ``kept`` holds the other bytes, which may end within a
    character. Null texts are empty. A null id is larger than any other; rows
    that share an id, null or not, never repeat each other. No rows give none.
    """
    if window < 2 * PERIOD:
        raise ValueError(f"a window has at least {2 * PERIOD} bytes")
    spark = ready(docs.sparkSession)
    blocks = _stored_blocks(docs, doc_id, text)
    size = blocks.select(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(64, max(16, int(size).bit_length() + SPARE_BITS))
    buckets = max(least, size * len(COVER) // PERIOD // ENTRIES_PER_RANGE)
    stored = blocks.select("block", "ids", "lengths", "texts").groupBy("block")
    copies = written(_copies(blocks), "copies")

    seen = stored.cogroup(copies.groupBy("block")).applyInPandas(_sample_names(window, bits, buckets), MESSAGES)
    several = written(seen.groupBy("bucket").applyInPandas(_names_in_several_blocks, MESSAGES), "several")

    told = copies.unionByName(several)
    windows = stored.cogroup(told.groupBy("block")).applyInPandas(_window_names(window, bits, buckets, buckets), MESSAGES)
    repeats = written(windows.groupBy("bucket").applyInPandas(_windows_of_smaller_ids, MESSAGES), "repeats")

    found = copies.unionByName(repeats)
    return stored.cogroup(found.groupBy("block")).applyInArrow(
        lambda a, b: _marked(window, buckets)(a.to_pandas(), b.to_pandas()), RESULT
    )
