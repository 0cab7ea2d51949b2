"""Token ids as tables of bit-plane shuffled blocks, in ascending document order.

A stored table has one row per block of ``BLOCK_IDS`` ids. Ids are split into
planes (all lowest bytes, all next bytes, ...; or all lowest bits, ...), which
compress far better than whole ids, each with zstandard. The columns besides
``payload`` are the chunk index: where the block starts, how long its planes
are, and which documents begin in it, so a span of ids is read from its blocks
alone. Parquet holds the rows, and so any store that Spark reads will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galecast.llm.session import fresh_path, ready
from galecast.llm.textblocks import text_blocks
from galecast.llm.tokens import encoder

BLOCK_IDS = 1 << 16
DOCS_PER_PART = 4096
STORED = (
    "part int, chunk int, first_id long, n_ids int, planes string, plane_sizes array<int>, "
    "doc_ids array<long>, doc_lengths array<long>, payload binary"
)
SPANS = "part int, local long, doc_id long, n_tokens long, ids_crc32 long"


def pack_block(ids: np.ndarray, planes: str = "bytes", level: int = 3) -> tuple[list[int], bytes]:
    """Sizes of the compressed planes and the planes, lowest first; high planes without a bit are left out."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    as_bytes = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bytes":
        rows = [np.ascontiguousarray(as_bytes[:, k]) for k in range((width + 7) // 8)]
    else:
        bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
        rows = [np.packbits(bits[:, k], bitorder="little") for k in range(width)]
    press = zstandard.ZstdCompressor(level=level)
    packed = [press.compress(r.tobytes()) for r in rows]
    return [len(p) for p in packed], b"".join(packed)


def unpack_block(n_ids: int, planes: str, sizes: Iterable[int], payload: bytes) -> np.ndarray:
    """The ids of a block, as unsigned 32-bit numbers."""
    open_ = zstandard.ZstdDecompressor()
    as_bytes = np.zeros((n_ids, 4), np.uint8)
    bits = np.zeros((n_ids, 32), np.uint8) if planes == "bits" else None
    at = 0
    for k, size in enumerate(sizes):
        plane = np.frombuffer(open_.decompress(payload[at : at + size]), np.uint8)
        at += size
        if bits is None:
            as_bytes[:, k] = plane
        else:
            bits[:, k] = np.unpackbits(plane, count=n_ids, bitorder="little")
    if bits is not None:
        as_bytes = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(as_bytes).view("<u4").reshape(-1).copy()


def _block_writer(tokenizer: str, end_id: int, planes: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, True).encode, TaskContext.get().partitionId()
        waiting, n_waiting, first, chunk = [], 0, 0, 0
        docs: list[tuple[int, int | None, int]] = []  # start, doc_id, length
        position = 0

        def emit(n: int) -> pa.RecordBatch:
            nonlocal waiting, n_waiting, first, chunk, docs
            ids = np.concatenate(waiting)
            block, rest = ids[:n], ids[n:]
            waiting, n_waiting = [rest], len(rest)
            here = [d for d in docs if d[0] < first + n]
            docs = docs[len(here) :]
            sizes, payload = pack_block(block, planes)
            row = [part], [chunk], [first], [n], [planes], [sizes], [[d[1] for d in here]], [[d[2] for d in here]], [payload]
            first, chunk = first + n, chunk + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _STORED_ARROW.types)], schema=_STORED_ARROW)

        for batch, data, off in text_blocks(batches):
            ids, ends = encode(data, off, end_id)
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                docs.append((position + a, doc_id, b - a))
            position += len(ids)
            waiting.append(ids)
            n_waiting += len(ids)
            while n_waiting >= BLOCK_IDS:
                yield emit(BLOCK_IDS)
        if n_waiting:
            yield emit(n_waiting)

    return write


_STORED_ARROW = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.string()),
    ("plane_sizes", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
    ("payload", pa.binary()),
])
_SPANS_ARROW = pa.schema([
    ("part", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())
])


def write_ids(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 0, planes: str = "bytes") -> str:
    """Encodes all texts and stores their ids in ascending doc_id order; returns the table's path.

    Null text is empty and has the end id alone. Null ids come first; rows
    with equal ids follow each other in the order of their texts. A part holds
    a range of documents; its blocks follow each other by ``chunk``.
    """
    spark = ready(docs.sparkSession)
    path = path or fresh_path(spark, "token-ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // DOCS_PER_PART))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    stored = ordered.mapInArrow(_block_writer(tokenizer, end_id, planes), STORED)
    stored.write.option("compression", "none").parquet(path)
    return path


def _span_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checks and sums the ids of every document from blocks in order; holds one block at a time."""
    part, local, queue, left, crc, rows = None, 0, [], 0, 0, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] != part:
                part, local, queue, left, crc = r["part"], 0, [], 0, 0
            ids = unpack_block(r["n_ids"], r["planes"], r["plane_sizes"], r["payload"]).astype("<u4").tobytes()
            queue += zip(r["doc_ids"], r["doc_lengths"])
            at, done = 0, 0
            while at < len(ids):
                doc_id, n = queue[done]
                left = left or 4 * n
                take = min(left, len(ids) - at)
                crc = zlib.crc32(memoryview(ids)[at : at + take], crc)
                at, left = at + take, left - take
                if not left:
                    rows.append((part, local, doc_id, n, crc))
                    local, crc, done = local + n, 0, done + 1
            queue = queue[done:]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*rows), _SPANS_ARROW)], schema=_SPANS_ARROW
            )
            rows = []


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the stored blocks: doc_id, start, n_tokens, ids_crc32."""
    stored = ready(spark).read.schema(STORED).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )  # one row per part
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    in_order = stored.repartition(n, "part").sortWithinPartitions("part", "chunk")
    spans = in_order.mapInArrow(_span_reader, SPANS)
    return spans.join(bases, "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, part: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a part, from the blocks that the index names; a span fits in memory."""
    hit = (F.col("part") == part) & (F.col("first_id") < end) & (F.col("first_id") + F.col("n_ids") > start)
    rows = sorted(spark.read.schema(STORED).parquet(path).where(hit).collect(), key=lambda r: r.first_id)
    ids = [unpack_block(r.n_ids, r.planes, r.plane_sizes, bytes(r.payload)) for r in rows]
    return np.concatenate(ids)[start - rows[0].first_id : end - rows[0].first_id] if ids else np.zeros(0, np.uint32)
