"""Language model scores from class-based word n-grams.

Counts come from all training texts: every word's count, and the bigrams among
the ``CLASSED`` most frequent words, the end of a text, and all other words as
one. Exchange clustering moves one word at a time to the class that raises the
likelihood of the class bigrams most; its input is a matrix of fixed size. Then
every other word of the ``FREQUENT`` most frequent ones joins the class that the
same measure prefers, by the classes it was seen next to: these counts are
dealt by ranges of words, and all words of a range are placed at once. At last
class bigrams are counted anew over all texts. A text's probability is the
product, over its tokens, of a class given the class before and a word given its
class. Words beyond the frequent ones share one class in which they are as
likely as their counts plus one; what has never been seen is one more word
there, and how often that class follows is learned from words seen once.

The counts of rare words need not fit in one place: the most frequent words,
at most ``FREQUENT``, are known to every task, and tokens of other words go, packed
into arrays, to the task that holds the counts of their hash range, which
sends back what each text needs, one number per text and range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.session import ready, written
from galecast.llm.suffixes import packed, unpacked
from galecast.llm.textblocks import LOWER_VALUES, span_hashes, text_blocks, words

CLASSED = 2046
CLASSES = 64
FREQUENT = 1 << 18
SWEEPS = 6
SMOOTHING = 0.1
DOCS_PER_RANGE = 16_384
SLAB = 64
FLUSH = 1 << 21
WORDS_PER_RANGE = 4096
WORDS_AT_ONCE = 256
END, OTHER = 0, 1  # ids before those of the classed words


def _ranges(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _split(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Values by key, each as one array of bytes."""
    order = np.argsort(key, kind="stable")
    present, at = np.unique(key[order], return_index=True)
    spans = list(zip(at.tolist(), [*at[1:].tolist(), len(key)]))
    return present, [[v[order][a:b].tobytes() for a, b in spans] for v in values]


def _joined(parts: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(keys, return_inverse=True)
    return found, np.bincount(where, weights=counts, minlength=len(found)).astype(np.int64)


# ---- counts of words -------------------------------------------------------------------

COUNTS = "range int, hashes binary, counts binary"


def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            h, c = _summed(np.concatenate(hashes), np.concatenate(counts))
            present, parts = _split(_ranges(h, bits), h, c)
            return pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], names=["range", "hashes", "counts"])

        for _, data, off in text_blocks(batches):
            starts, ends, _rows = words(data, off)
            h, c = np.unique(span_hashes(data, starts, ends, LOWER_VALUES), return_counts=True)
            hashes.append(h)
            counts.append(c)
            waiting += len(h)
            if waiting >= FLUSH:
                yield flush()
                hashes, counts, waiting = [], [], 0
        if waiting:
            yield flush()

    return run


def _merge_counts(rows: pd.DataFrame) -> pd.DataFrame:
    h, c = _summed(_joined(rows["hashes"], np.uint64), _joined(rows["counts"], np.int64))
    return pd.DataFrame({
        "range": rows["range"].iloc[:1], "hashes": [h.tobytes()], "counts": [c.tobytes()], "n_words": [len(h)], "n_tokens": [int(c.sum())]
    })


def _grade(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of a few hundred grades."""
    return np.floor(16 * np.log2(counts)).astype(np.int64)


def _grades(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for raw in batch["counts"]:
            grade, n = np.unique(_grade(np.frombuffer(raw, np.int64)), return_counts=True)
            yield pd.DataFrame({"grade": grade, "n": n})


def _words_from(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw_h, raw_c in zip(batch["hashes"], batch["counts"]):
                h, c = np.frombuffer(raw_h, np.uint64), np.frombuffer(raw_c, np.int64)
                keep = _grade(c) >= least
                yield pd.DataFrame({"hash": h[keep].view(np.int64), "count": c[keep]})

    return run


def _most_frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words down to a grade with which they are at most ``limit``, most frequent first."""
    grades = counts.select("counts").mapInPandas(_grades, "grade long, n long").groupBy("grade").agg(F.sum("n").alias("n")).collect()
    least, taken = 1 << 20, 0
    for row in sorted(grades, reverse=True):
        taken += row["n"]
        if taken > limit:
            break
        least = row["grade"]
    top = counts.select("hashes", "counts").mapInPandas(_words_from(least), "hash long, count long").toPandas()
    hashes, n = top["hash"].to_numpy(np.int64).view(np.uint64), top["count"].to_numpy(np.int64)
    order = np.lexsort((hashes, -n))
    return hashes[order], n[order]


# ---- bigrams and classes ---------------------------------------------------------------


def _token_ids(hashes: np.ndarray, known: np.ndarray, known_id: np.ndarray) -> np.ndarray:
    """Id of every word by its hash; OTHER where it has none."""
    if not len(known):
        return np.full(len(hashes), OTHER, np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, known_id[at], OTHER)


def _with_ends(ids: np.ndarray, rows: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts with an END after each, and the text of every token."""
    stops = np.searchsorted(rows, np.arange(n_texts), "right")
    return np.insert(ids, stops, END), np.insert(rows, stops, np.arange(n_texts))


def _count_bigrams(held_known, n_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_id = held_known.value
        codes, counts, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            k, c = _summed(np.concatenate(codes), np.concatenate(counts))
            present, parts = _split(k // (SLAB * n_ids), k.astype(np.int32), c.astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], names=["slab", "codes", "counts"])

        for _, data, off in text_blocks(batches):
            starts, ends, rows = words(data, off)
            ids = _token_ids(span_hashes(data, starts, ends, LOWER_VALUES), known, known_id)
            ids, _of = _with_ends(ids, rows, len(off) - 1)
            before = np.concatenate([[END], ids[:-1]])  # the end of a text stands before the next one
            k, c = np.unique(before * n_ids + ids, return_counts=True)
            codes.append(k)
            counts.append(c)
            waiting += len(k)
            if waiting >= FLUSH:
                yield flush()
                codes, counts, waiting = [], [], 0
        if waiting:
            yield flush()

    return run


def _merge_bigrams(n_ids: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        slab = int(rows["slab"].iloc[0])
        at = _joined(rows["codes"], np.int32).astype(np.int64) - slab * SLAB * n_ids
        total = np.bincount(at, weights=_joined(rows["counts"], np.int32), minlength=SLAB * n_ids).astype(np.int64)
        return pd.DataFrame({"slab": [slab], "counts": [total.tobytes()]})

    return run


def exchange_classes(bigrams: np.ndarray, n_classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every id; END and OTHER keep classes 0 and 1 for themselves.

    Words start in turn by their order (most frequent first). A sweep takes
    each word out of its class and puts it where sum n(g,h) log n(g,h) minus
    sum over g of both margins log of the margin is largest; it ends early when
    no word moves.
    """
    n = len(bigrams)
    k = max(1, min(n_classes, n - 2))
    cls = np.concatenate([[0, 1], 2 + np.arange(n - 2) % k]).astype(np.int64)
    m = k + 2
    left, right = bigrams.sum(axis=1).astype(float), bigrams.sum(axis=0).astype(float)
    member = np.zeros((n, m))
    member[np.arange(n), cls] = 1
    pairs = member.T @ bigrams @ member
    to = bigrams @ member  # counts of id followed by class
    fro = bigrams.T @ member  # counts of class followed by id
    g_left, g_right = pairs.sum(axis=1), pairs.sum(axis=0)

    def xlogx(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    for _ in range(sweeps):
        moved = 0
        for w in range(2, n):
            if left[w] + right[w] == 0:
                continue
            own, self_count = cls[w], float(bigrams[w, w])
            t, f = to[w].copy(), fro[w].copy()
            t[own] -= self_count
            f[own] -= self_count  # without the word itself
            pairs[own, :] -= t
            pairs[:, own] -= f
            pairs[own, own] -= self_count
            g_left[own] -= left[w]
            g_right[own] -= right[w]
            # Gain of joining class c: rows c of t, columns c of f, and the corner (c, c).
            across = xlogx(pairs + t[None, :]) - xlogx(pairs)
            along = xlogx(pairs + f[:, None]) - xlogx(pairs)
            corner = np.diagonal(pairs)
            gain = across.sum(axis=1) + along.sum(axis=0)
            gain += xlogx(corner + t + f + self_count) - xlogx(corner) - np.diagonal(across) - np.diagonal(along)
            gain -= xlogx(g_left + left[w]) - xlogx(g_left) + xlogx(g_right + right[w]) - xlogx(g_right)
            gain[:2] = -np.inf
            new = int(gain.argmax())
            pairs[new, :] += t
            pairs[:, new] += f
            pairs[new, new] += self_count
            g_left[new] += left[w]
            g_right[new] += right[w]
            if new != own:
                moved += 1
                cls[w] = new
                to[:, own] -= bigrams[:, w]
                to[:, new] += bigrams[:, w]
                fro[:, own] -= bigrams[w]
                fro[:, new] += bigrams[w]
        if not moved:
            break
    return cls


# ---- all frequent words ------------------------------------------------------------------

NEIGHBOURS = "range int, codes binary, counts binary"
PLACED = "range int, classes binary"


@dataclass(frozen=True)
class Lexicon:
    """``known``: sorted hashes of the frequent words; ``cls``: their classes, OTHER where there is none yet."""

    known: np.ndarray
    cls: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of every word among the known ones, -1 for the others."""
        if not len(self.known):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, -1)

    def classes(self, places: np.ndarray) -> np.ndarray:
        return np.where(places >= 0, self.cls[np.maximum(places, 0)], OTHER) if len(self.known) else np.full(len(places), OTHER)


def _token_classes(lexicon: Lexicon, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and class of every token of a block, an END after each text, and the text of every token."""
    starts, ends, rows = words(data, off)
    places = lexicon.places(span_hashes(data, starts, ends, LOWER_VALUES))
    n = len(off) - 1
    stops = np.searchsorted(rows, np.arange(n), "right")
    classes = np.insert(lexicon.classes(places), stops, END)
    return np.insert(places, stops, -1), classes, np.insert(rows, stops, np.arange(n))


def _count_neighbours(held, m: int):
    """How often each word without a class stood before and behind each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = held.value
        codes, counts, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            k, c = _summed(np.concatenate(codes), np.concatenate(counts))
            span = WORDS_PER_RANGE * 2 * m
            present, at = np.unique(k // span, return_index=True)
            edges = [*at.tolist(), len(k)]
            parts = [(packed(k[i:j] - r * span), packed(np.cumsum(c[i:j]))) for r, i, j in zip(present.tolist(), edges[:-1], edges[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(present, pa.int32()), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())],
                names=["range", "codes", "counts"],
            )

        for _, data, off in text_blocks(batches):
            places, classes, _ = _token_classes(lexicon, data, off)
            loose = np.flatnonzero((places >= 0) & (classes == OTHER))
            before = np.concatenate([[END], classes[:-1]])[loose]
            after = np.concatenate([classes[1:], [END]])[loose]
            both = np.concatenate([places[loose] * 2 * m + after, places[loose] * 2 * m + m + before])
            k, c = np.unique(both, return_counts=True)
            codes.append(k)
            counts.append(c)
            waiting += len(k)
            if waiting >= FLUSH:
                yield flush()
                codes, counts, waiting = [], [], 0
        if waiting:
            yield flush()

    return run


def best_classes(pairs: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Class for each of many words, by the measure of ``exchange_classes`` with the others in place.

    ``after`` and ``before``: how often each class followed and preceded the
    words. END and OTHER take no words; a word never seen next to a class goes
    to the largest one.
    """
    def xlogx(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    def along(table: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Per word and class c the sum over the classes h it was seen next to: what table[c, h] gains."""
        out = np.zeros(seen.shape)
        word, h = np.nonzero(seen)
        if len(word):
            gains = xlogx(table.T[h] + seen[word, h][:, None]) - xlogx(table.T[h])
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            out[word[first]] = np.add.reduceat(gains, first, axis=0)
        return out

    g_left, g_right = pairs.sum(axis=1), pairs.sum(axis=0)
    corner = np.diagonal(pairs)
    gain = along(pairs, after) + along(pairs.T, before)
    gain += xlogx(corner + after + before) - xlogx(corner + after) - xlogx(corner + before) + xlogx(corner)
    left, right = after.sum(axis=1, keepdims=True), before.sum(axis=1, keepdims=True)
    gain -= xlogx(g_left + left) - xlogx(g_left) + xlogx(g_right + right) - xlogx(g_right)
    gain[:, :2] = -np.inf
    return gain.argmax(axis=1)


def _place_words(pairs: np.ndarray, n_known: int):
    m = len(pairs)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["range"].iloc[0])
        n = min(WORDS_PER_RANGE, n_known - part * WORDS_PER_RANGE)
        total = np.zeros(n * 2 * m)
        for codes, counts in zip(rows["codes"], rows["counts"]):
            total += np.bincount(unpacked(codes).astype(np.int64), weights=np.diff(unpacked(counts).astype(np.int64), prepend=0), minlength=len(total))
        seen = total.reshape(n, 2, m)
        out = np.full(n, OTHER, np.uint8)
        there = np.flatnonzero(seen.any(axis=(1, 2)))
        for i in range(0, len(there), WORDS_AT_ONCE):
            some = there[i : i + WORDS_AT_ONCE]
            out[some] = best_classes(pairs, seen[some, 0], seen[some, 1])
        return pd.DataFrame({"range": [part], "classes": [out.tobytes()]})

    return run


def _count_classes(held, held_once, m: int):
    """Bigrams of classes, and in a last column how often a word seen once followed each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = held.value
        once = held_once.value
        total = np.zeros((m, m + 1), np.int64)
        for _, data, off in text_blocks(batches):
            places, classes, _ = _token_classes(lexicon, data, off)
            before = np.concatenate([[END], classes[:-1]])
            total[:, :m] += np.bincount(before * m + classes, minlength=m * m).reshape(m, m)
            rare = (places >= 0) & once[np.maximum(places, 0)] if len(once) else np.zeros(len(places), bool)
            total[:, m] += np.bincount(before[rare], minlength=m)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.reshape(-1)[at], pa.int64())], names=["code", "n"])

    return run


@dataclass(frozen=True)
class ClassModel:
    """``lexicon``: the frequent words and their classes; ``counts``: theirs.

    ``step``: log10 of class given class before; ``emit``: log10 of a frequent
    word given its class.
    """

    lexicon: Lexicon
    counts: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    other_total: float


def _class_model(lexicon: Lexicon, counts: np.ndarray, followed: np.ndarray, n_other_words: int) -> ClassModel:
    m = len(followed)
    pairs, once = followed[:, :m].astype(float), followed[:, m].astype(float)
    total = pairs.sum(axis=1) + SMOOTHING * m
    unseen = (pairs[:, OTHER] + once + SMOOTHING) / (total + once)
    rest = pairs + SMOOTHING
    rest[:, OTHER] = 0
    step = (1 - unseen)[:, None] * rest / rest.sum(axis=1, keepdims=True)
    step[:, OTHER] = unseen
    in_class = np.bincount(lexicon.cls, weights=counts, minlength=m) if len(counts) else np.zeros(m)
    emit = np.log10(counts / np.maximum(in_class[lexicon.cls], 1)) if len(counts) else np.zeros(0)
    return ClassModel(lexicon, counts, np.log10(step), emit, float(pairs[:, OTHER].sum()) + n_other_words + 1)


# ---- scores ----------------------------------------------------------------------------

SCORED = "text_key long, doc_id long, n_tokens long, n_known long, base double, score double, range int, hashes binary, keys binary"
_SCORED_ARROW = pa.schema([
    ("text_key", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
    ("score", pa.float64()), ("range", pa.int32()), ("hashes", pa.binary()), ("keys", pa.binary()),
])


def _score_frequent(held_model, end_count: int, bits: int):
    """Sums over the frequent words of every text, and the tokens of all others, packed by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ClassModel = held_model.value
        log_count = np.log10(model.counts + 1.0)
        number = TaskContext.get().partitionId() << 36
        hashes, keys, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            h, k = np.concatenate(hashes), np.concatenate(keys)
            present, parts = _split(_ranges(h, bits), h, k)
            empty = [pa.nulls(len(present), f.type) for f in list(_SCORED_ARROW)[:6]]
            return pa.RecordBatch.from_arrays([*empty, pa.array(present, pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], schema=_SCORED_ARROW)

        for batch, data, off in text_blocks(batches):
            n = len(off) - 1
            starts, ends, rows = words(data, off)
            h = span_hashes(data, starts, ends, LOWER_VALUES)
            at = model.lexicon.places(h)
            frequent = at >= 0
            counted = np.bincount(rows[frequent], minlength=n)
            base = np.bincount(rows[frequent], weights=log_count[at[frequent]], minlength=n) + np.log10(end_count + 1.0)
            classes, of = _with_ends(model.lexicon.classes(at), rows, n)
            each = model.step[np.concatenate([[END], classes[:-1]]), classes]
            each[classes == OTHER] -= np.log10(model.other_total)
            score = np.bincount(of, weights=each, minlength=n)
            score += np.bincount(rows[frequent], weights=model.emit[at[frequent]], minlength=n)
            n_tokens = np.bincount(of, minlength=n)
            key = number + np.arange(n)
            number += n
            left = [pa.nulls(n, f.type) for f in list(_SCORED_ARROW)[6:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(counted + (end_count > 0), pa.int64()), pa.array(base), pa.array(score), *left],
                schema=_SCORED_ARROW,
            )
            if not frequent.all():
                hashes.append(h[~frequent])
                keys.append(key[rows[~frequent]])
                waiting += int((~frequent).sum())
                if waiting >= FLUSH:
                    yield flush()
                    hashes, keys, waiting = [], [], 0
        if waiting:
            yield flush()

    return run


def _rare_sums(key: tuple, tokens: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Per text the sum of log10(count + 1) and the number of known words among its tokens of one hash range."""
    h, k = _joined(tokens["hashes"], np.uint64), _joined(tokens["keys"], np.int64)
    known, known_count = _joined(counts["hashes"], np.uint64), _joined(counts["counts"], np.int64)
    if len(known) and len(h):
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        count = np.where(known[at] == h, known_count[at], 0)
    else:
        count = np.zeros(len(h), np.int64)
    h, k, count = h[count > 0], k[count > 0], count[count > 0]
    texts, where = np.unique(k, return_inverse=True)
    sums = np.bincount(where, weights=np.log10(count + 1.0), minlength=len(texts))
    known_tokens = np.bincount(where, minlength=len(texts)).astype(np.int64)
    # Texts of one task of the pass before go to one place.
    present, parts = _split(texts >> 30, texts, sums, known_tokens)
    return pd.DataFrame({"place": present, "texts": parts[0], "sums": parts[1], "known": parts[2]})


def _unpacked(rows: pd.DataFrame) -> pd.DataFrame:
    texts, where = np.unique(_joined(rows["texts"], np.int64), return_inverse=True)
    sums = np.bincount(where, weights=_joined(rows["sums"], np.float64), minlength=len(texts))
    known = np.bincount(where, weights=_joined(rows["known"], np.int64), minlength=len(texts)).astype(np.int64)
    return pd.DataFrame({"text_key": texts, "rare_sum": sums, "rare_known": known})


def class_scores(docs: DataFrame, learns: Column, classed: int = CLASSED, n_classes: int = CLASSES, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10).

    Tokens are the words, A-Z lower-cased, and one end per text; null text has
    the end alone. Rows for which ``learns`` is not true are scored but not
    learned from; with none to learn from, every word is unseen. Rows that
    repeat an id are texts of their own.
    """
    spark = ready(docs.sparkSession)
    context = spark.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(learns, F.lit(False)).alias("_learns"))
    n_rows, n_learned = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("_learns").cast("long")), F.lit(0))).first()
    bits = max(2, (n_rows // DOCS_PER_RANGE).bit_length())
    learned = texts.where("_learns").select("text")

    counts = written(
        learned.mapInArrow(_count_words(bits), COUNTS).groupBy("range").applyInPandas(_merge_counts, COUNTS + ", n_words long, n_tokens long"), "word-counts"
    )
    n_words, n_word_tokens = counts.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    n_words, n_tokens = n_words + (n_learned > 0), n_word_tokens + n_learned  # with the end
    hashes, known_counts = _most_frequent(counts, frequent)
    by_hash = np.argsort(hashes)
    known, known_counts_sorted = hashes[by_hash], known_counts[by_hash]
    classes_hash = hashes[:classed]
    order = np.argsort(classes_hash)
    classed_hash, classed_id = classes_hash[order], order + 2

    n_ids = len(classes_hash) + 2
    held_known = context.broadcast((classed_hash, classed_id))
    slabs = (
        learned.mapInArrow(_count_bigrams(held_known, n_ids), "slab int, codes binary, counts binary")
        .groupBy("slab").applyInPandas(_merge_bigrams(n_ids), "slab int, counts binary")
    )
    bigrams = np.zeros((-(-n_ids // SLAB) * SLAB, n_ids), np.int64)
    for row in slabs.collect():  # at most (CLASSED + 2) squared counts
        bigrams[row["slab"] * SLAB : (row["slab"] + 1) * SLAB] = np.frombuffer(row["counts"], np.int64).reshape(SLAB, n_ids)
    bigrams = bigrams[:n_ids].astype(np.float64)
    cls_of_ids = exchange_classes(bigrams, n_classes)
    m = int(cls_of_ids.max()) + 1
    member = np.zeros((n_ids, m))
    member[np.arange(n_ids), cls_of_ids] = 1
    pairs = member.T @ bigrams @ member

    cls = np.full(len(known), OTHER, np.int64)
    cls[np.searchsorted(known, classed_hash)] = cls_of_ids[classed_id]
    if len(known) > len(classed_hash):
        held = context.broadcast(Lexicon(known, cls))
        placed = (
            learned.mapInArrow(_count_neighbours(held, m), NEIGHBOURS).groupBy("range")
            .applyInPandas(_place_words(pairs, len(known)), PLACED)
        )
        for row in placed.collect():  # a byte per frequent word
            part = slice(row["range"] * WORDS_PER_RANGE, (row["range"] + 1) * WORDS_PER_RANGE)
            found = np.frombuffer(row["classes"], np.uint8)
            cls[part] = np.where(cls[part] == OTHER, found, cls[part])
    lexicon = Lexicon(known, cls)
    followed = np.zeros(m * (m + 1), np.int64)
    counted = learned.mapInArrow(_count_classes(context.broadcast(lexicon), context.broadcast(known_counts_sorted == 1), m), "code long, n long")
    for row in counted.groupBy("code").agg(F.sum("n").alias("n")).collect():  # classes squared
        followed[row["code"]] = row["n"]
    model = _class_model(lexicon, known_counts_sorted.astype(float), followed.reshape(m, m + 1), n_words - (n_learned > 0) - len(known))

    held_model = context.broadcast(model)  # bounded by ``frequent`` and the classes
    scored = written(texts.select("doc_id", "text").mapInArrow(_score_frequent(held_model, n_learned, bits), SCORED), "scored")
    rare = scored.where("range is not null").select("range", "hashes", "keys").groupBy("range")
    sums = rare.cogroup(counts.select("range", "hashes", "counts").groupBy("range")).applyInPandas(
        _rare_sums, "place long, texts binary, sums binary, known binary"
    )
    per_text = sums.groupBy("place").applyInPandas(_unpacked, "text_key long, rare_sum double, rare_known long")
    found = scored.where("range is null").select("text_key", "doc_id", "n_tokens", "n_known", "base", "score").join(per_text, "text_key", "left")
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    return found.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(n_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + rare_sum - F.col("n_tokens") * F.lit(float(np.log10(n_tokens + n_words + 1)))).alias("base_score"),
        (F.col("score") + rare_sum).alias("score"),
    )
