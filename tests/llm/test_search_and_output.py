from __future__ import annotations

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galecast.llm import bitplanes, packing, topk
from galecast.llm.textblocks import text_blocks, words
from galecast.llm.tokens import encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def brute_ids(path: str, texts: list[str | None], end: int) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(path)
    return [e.ids + [end] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path,spaces", [(BYTE, True), (WORD, False)])
def test_chunked_ids_are_those_of_whole_texts(odd_rows, path, spaces):
    texts = [r[1] for r in odd_rows] + ["a  b", " a ", " x  y", "a  b", "x\n\n  y's's,'s ''ll a'b", "É É,É", "\x1c a\x1d b", "e ́x"]
    texts += [f"{a}{m}{b}" for m in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "<|endoftext") for a in ("", "a ", "it's", " \n", "<") for b in ("", " b", "on", "\n ", "|>", ">")]
    got = []
    for _, data, off in text_blocks([pa.record_batch([pa.array(texts)], ["text"])], size=500):
        ids, ends = encoder(path, spaces).encode(data, off, 1)
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert got == brute_ids(path, texts, 1)


def test_words_of_blocks():
    texts = ["a b", None, "", " c", "d ", "e"]
    for _, data, off in text_blocks([pa.record_batch([pa.array(texts)], ["text"])]):
        starts, ends, rows = words(data, off)
        assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends)] == ["a", "b", "c", "d", "e"]
        assert rows.tolist() == [0, 0, 3, 4, 5]


@pytest.mark.parametrize("planes", ["bytes", "bits"])
def test_blocks_round_trip(planes):
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, np.uint32), np.zeros(9, np.uint32), rng.integers(0, 50257, 1000).astype(np.uint32), np.array([2**32 - 1, 0], np.uint32)):
        sizes, payload = bitplanes.pack_block(ids, planes)
        assert bitplanes.unpack_block(len(ids), planes, sizes, payload).tolist() == ids.tolist()


@pytest.mark.parametrize("planes", ["bytes", "bits"])
def test_stored_ids(spark, odd_docs, odd_rows, planes, monkeypatch):
    monkeypatch.setattr(bitplanes, "BLOCK_IDS", 1000)
    path = bitplanes.write_ids(odd_docs, BYTE, planes=planes)
    got = sorted(map(tuple, bitplanes.read_spans(spark, path).collect()), key=lambda r: r[1])
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for row, ids in zip(ordered, brute_ids(BYTE, [r[1] for r in ordered], 0)):
        want.append((row[0], start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    part = spark.read.parquet(path).agg(F.min("part")).first()[0]
    first = brute_ids(BYTE, [ordered[0][1], ordered[1][1]], 0)
    assert bitplanes.read_ids(spark, path, part, 0, 2).tolist() == (first[0] + first[1])[:2]


def test_no_documents_to_store(spark, no_docs):
    assert bitplanes.read_spans(spark, bitplanes.write_ids(no_docs, BYTE)).count() == 0


def test_packing(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 30)
    rows = packing.pack_documents(odd_docs, WORD).collect()
    want = []
    for row, ids in zip(odd_rows, brute_ids(WORD, [r[1] for r in odd_rows], 1)):
        want += [(row[0], k, 4096 * k, len(p), crc(p)) for k, p in enumerate(ids[i : i + 4096] for i in range(0, len(ids), 4096))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in sequences.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == math.ceil(sum(w[3] for w in want) / 4096)


def test_no_documents_to_pack(no_docs):
    assert packing.pack_documents(no_docs, WORD).count() == 0


def fewest_bins(lengths: list[int], capacity: int) -> int:
    best = len(lengths)

    def place(i: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_bin_completion_finds_the_fewest_bins():
    rng = np.random.default_rng(3)
    better = 0
    for _ in range(60):
        lengths = sorted(rng.integers(15, 60, 9).tolist(), reverse=True)
        bins = packing.bin_completion(lengths, 100)
        assert sorted(n for b in bins for n in b) == sorted(lengths) and max(map(sum, bins)) <= 100
        assert len(bins) == fewest_bins(lengths, 100)
        better += len(bins) < len(packing.best_fit(lengths, 100))
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]  # best fit decreasing needs one more
    hard = packing.bin_completion(lengths, 61)
    assert len(hard) == fewest_bins(lengths, 61)


def test_bin_completion_of_many_pieces_a_bin():
    rng = np.random.default_rng(5)
    better = 0
    for _ in range(60):  # cut from full bins, so the fewest are known
        lengths = []
        for k in rng.integers(6, 13, 4).tolist():
            lengths += (14 + rng.multinomial(200 - 14 * k, np.ones(k) / k)).tolist()
        bins = packing.bin_completion(lengths, 200)
        assert sorted(n for b in bins for n in b) == sorted(lengths) and max(map(sum, bins)) <= 200
        assert len(bins) == 4
        better += len(packing.best_fit(lengths, 200)) > 4
    assert better > 30  # best fit decreasing needs one more
    lengths = [29, 25, 23, 21, 18, 17, 15, 14, 13, 12, 12, 11, 9, 8, 7, 6, 6, 5, 5, 4]
    assert len(packing.bin_completion(lengths, 90)) == fewest_bins(lengths, 90)


def test_every_filling_that_no_other_dominates_is_found():
    rng = np.random.default_rng(6)
    for _ in range(40):
        lengths, room = rng.integers(3, 14, 9).tolist(), 40
        ways = {tuple(sorted((lengths[i] for i in range(9) if k >> i & 1), reverse=True)) for k in range(512)}
        ways = {w for w in ways if sum(w) <= room}

        def beaten(w: tuple) -> bool:
            outside = list(lengths)
            for n in w:
                outside.remove(n)
            parts = [[w[i] for i in range(len(w)) if k >> i & 1] for k in range(1 << len(w))]
            return any(
                sum(p) <= n and sum(w) - sum(p) + n <= room and (len(p) != 1 or n > p[0]) for p in parts for n in outside
            )

        got = [f for f in packing.undominated_fillings(packing._Sizes(lengths), room) if f is not None]
        assert len(got) == len(set(got)) and set(got) == {w for w in ways if not beaten(w)}
        assert [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)


def test_empty_and_single_packings():
    assert packing.bin_completion([], 10) == []
    assert packing.bin_completion([10], 10) == [[10]]


def brute_top(rows: dict[int, list], every: int, k: int) -> set[tuple]:
    out = set()
    for q in rows:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(rows[q], v)), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_exact_top_k(spark, shard_rows):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(300)]
    rows += [(i, [0.25] * 6) for i in range(300, 420)]  # ties
    rows += [(500 + i, rng.normal(0, 1, 3).tolist()) for i in range(3)]  # another length, fewer than k
    bad = [(None, [1.0] * 6), (600, None), (650, []), (700, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (750, [float("nan")] * 6), (800, [float("inf")] * 6)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x")).withColumn("score", F.lit(1))
    table = table.withColumnRenamed("vec_id", "vec_id")
    got = {tuple(r) for r in topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 10 == 0, 5, shard_rows).collect()}
    ints = {i: [math.floor(float(np.float32(x)) * 256) for x in v] for i, v in rows}
    assert got == brute_top(ints, 10, 5)


def test_top_k_of_nothing_and_of_huge_numbers(spark):
    schema = "vec_id long, embedding array<double>"
    assert topk.top_k(topk.integer_vectors(spark.createDataFrame([], schema)), F.lit(True)).count() == 0
    rows = [(0, [3e6, 1.0]), (1, [2e6, 5.0]), (2, [2e6, 7.0]), (3, [-1.0, 0.0])]
    got = {tuple(r) for r in topk.top_k(topk.integer_vectors(spark.createDataFrame(rows, schema)), F.col("vec_id") == 0, 2).collect()}
    assert got == brute_top({i: [int(x * 256) for x in v] for i, v in rows}, 10, 2)
