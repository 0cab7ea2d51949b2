"""Quality scores from a small convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover it whole. Filters of
``WIDTH`` bytes slide over every chunk byte by byte; the largest response of
each filter in a chunk is its feature, the features are averaged over the
chunks, and a logistic unit makes one probability of them. As the input is
one byte of 256 at each place, a filter is a table of 256 numbers per place,
and a convolution is a sum of rows looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.session import ready
from galecast.llm.textblocks import text_blocks, text_buffers

SAMPLE = 1600
FILTERS = 16
WIDTH = 6
CHUNK = 256
OVERLAP = 32
CHUNKS_AT_ONCE = 1024
EPOCHS = 14
PREDICT_FROM = 0.3


def chunks_of(off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, size and text of every chunk.

    Chunks of ``CHUNK`` bytes begin every ``CHUNK - OVERLAP`` bytes; the last
    one ends with the text, so with an overlap of more than a filter's width no
    window is missed. An empty text has one chunk.
    """
    length = np.diff(off)
    step = CHUNK - OVERLAP
    chunks = np.maximum(1, -(-(length - OVERLAP) // step))
    text = np.repeat(np.arange(len(length)), chunks)
    number = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = off[:-1][text] + number * step
    return begin, np.minimum(CHUNK, off[1:][text] - begin), text


def windows(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and the first window of every chunk: one at every byte. A text shorter than a filter has one, padded."""
    count = np.maximum(1, size - WIDTH + 1)
    first = np.cumsum(count) - count
    return np.repeat(begin - first, count) + np.arange(count.sum()), first


@dataclass
class QualityNet:
    """``tables``: (WIDTH, 256, FILTERS); ``bias``: FILTERS; ``dense``: FILTERS + 1, the last is the constant."""

    tables: np.ndarray
    bias: np.ndarray
    dense: np.ndarray

    def chunk_maxima(self, data: np.ndarray, start: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every chunk, before the bias; (chunks, filters)."""
        out = self._responses(data, start, stop)
        return np.maximum.reduceat(out, first, axis=0)

    def _responses(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        padded = np.append(data, np.zeros(WIDTH, np.uint8))
        out = self.tables[0][_byte_at(padded, start, stop)]
        for k in range(1, WIDTH):
            out += self.tables[k][_byte_at(padded, start + k, stop)]
        return out

    def features(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean over chunks of max-pooled, rectified responses; (texts, filters)."""
        begin, size, text = chunks_of(off)
        pooled = np.empty((len(text), FILTERS), np.float32)
        for i in range(0, len(text), CHUNKS_AT_ONCE):  # a long text takes the same work memory as many short ones
            part = slice(i, i + CHUNKS_AT_ONCE)
            start, first = windows(begin[part], size[part])
            best = self.chunk_maxima(data, start, first, _text_end(off, first, text[part], len(start)))
            pooled[part] = np.maximum(best + self.bias, 0)
        n = np.bincount(text, minlength=len(off) - 1)
        total = np.add.reduceat(pooled, np.cumsum(n) - n, axis=0)
        return total / n[:, None]

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        z = self.features(data, off) @ self.dense[:-1] + self.dense[-1]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def _text_end(off: np.ndarray, first: np.ndarray, text: np.ndarray, n: int) -> np.ndarray | None:
    """End of the text of every window, where a text may be shorter than a filter."""
    if np.all(np.diff(off) >= WIDTH):
        return None
    return np.repeat(off[1:][text], np.diff(np.append(first, n)))


def _byte_at(padded: np.ndarray, at: np.ndarray, stop: np.ndarray | None) -> np.ndarray:
    return padded[at] if stop is None else np.where(at < stop, padded[np.minimum(at, len(padded) - 1)], 0)


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> QualityNet:
    """Adam on the log loss, both labels weighing alike, from a fixed seed; one text is one example."""
    rng = np.random.default_rng(seed)
    net = QualityNet(
        rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        np.append(rng.normal(0, 0.3, FILTERS), 0.0).astype(np.float32),
    )
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():  # nothing to tell apart
        net.dense[:] = 0
        net.dense[-1] = 0 if not len(y) else (6 if y[0] else -6)
        return net
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y).mean()).astype(np.float32)
    params = [net.tables, net.bias, net.dense]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    batch = 64
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            data, off = text_buffers(pa.array([texts[j] for j in pick], pa.string()))
            begin, size, text = chunks_of(off)
            start, first = windows(begin, size)
            stop = _text_end(off, first, text, len(start))
            padded = np.append(data, np.zeros(WIDTH, np.uint8))
            raw = net._responses(data, start, stop)
            top = np.maximum.reduceat(raw, first, axis=0)
            count = np.diff(np.append(first, len(start)))
            # The window of the maximum, per chunk and filter: the first that reaches it.
            at_top = np.where(raw == np.repeat(top, count, axis=0), np.arange(len(start))[:, None], len(start))
            best = np.minimum.reduceat(at_top, first, axis=0)
            active = (top + net.bias) > 0
            n = np.bincount(text, minlength=len(pick))
            feats = np.add.reduceat(np.where(active, top + net.bias, 0), np.cumsum(n) - n, axis=0) / n[:, None]
            z = feats @ net.dense[:-1] + net.dense[-1]
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) * weight[pick] / len(pick)
            back = (error[:, None] * net.dense[:-1] / n[:, None])[text] * active
            grads = [np.zeros_like(net.tables), back.sum(axis=0), np.append(error @ feats + 1e-4 * net.dense[:-1], error.sum())]
            columns = np.broadcast_to(np.arange(FILTERS), best.shape)
            for k in range(WIDTH):
                at = start[best] + k
                value = _byte_at(padded, at, None if stop is None else stop[best])
                np.add.at(grads[0][k], (value, columns), back)
            t += 1
            rate = 0.01 * (1 - 0.8 * epoch / epochs)
            for p, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def training_sample(docs: DataFrame, labels: DataFrame, fits: Column, limit: int = SAMPLE) -> list[tuple[str, int]]:
    """At most ``limit`` hashed (text, quality) of labelled documents in a fixed order, half of each label where there are enough.

    Labels other than 0 and 1, and labels without a document, play no part.
    """
    key = F.xxhash64("doc_id", F.lit("quality"))
    usable = labels.where(fits & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"), key.alias("key"))
    halves = [usable.where(F.col("quality") == q).orderBy("key").limit(limit // 2) for q in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most ``limit`` rows
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").orderBy("key", "text").limit(limit).collect()
    return [(r["text"] or "", r["quality"]) for r in rows]


def score_quality(docs: DataFrame, net: QualityNet) -> DataFrame:
    """doc_id, score, predicted of every row; null text is empty, and both have a score."""
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for batch, data, off in text_blocks(batches, size=1 << 18):
            scores = net.score(data, off)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(score, f"doc_id {kind}, score double")
    return found.withColumn("predicted", F.when(F.col("score") >= PREDICT_FROM, 1).otherwise(0))
