"""Language identification with string kernels.

The kernel of two texts is the number of byte n-grams (n = 1, 2, 3) that both
hold, over the root of the product of their numbers: a blended spectrum of
presences, over the spectrum of the landmarks. Nyström landmarks turn it into
features, and kernel ridge regression, one language versus the rest, is fitted
on all labelled rows, by sums over them. Texts are scored block by block:
presences times landmarks times weights, two matrix products.

The values of a row have a fixed sum, so the largest one always claims a text.
Whether a text is in its language at all is told by its fluency, the mean
log-probability of its letters after the two before, against a threshold set
on all labelled rows that were not learned from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galecast.llm.session import ready, written
from galecast.llm.textblocks import text_blocks, text_buffers
from galecast.operators.percentiles import scope_statistics

SAMPLE_PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 24
MOST_LANGUAGES = 200
RIDGE = 1e-3
UNDETERMINED = "und"
UNSEEN = -4.0
SLACK = 4.0  # three deviations of one 3-gram
CLEAN_SHARE = 0.01
BLOCK_TEXTS = 256
BLOCK_BYTES = 1 << 19
_N_CODES = 256 + (1 << 16) + (1 << 24)
_fold = np.arange(256, dtype=np.uint8)
_fold[ord("A") : ord("Z") + 1] += 32
_letter = np.array([c if c >= 128 or chr(c).isalpha() else ord(" ") for c in range(256)], np.uint32)


def _windows(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes and text numbers of at most ``BLOCK_BYTES`` places and the two behind them, and the number of places.

    A long text takes the same work memory as many short ones.
    """
    for start in range(0, len(data), BLOCK_BYTES):
        stop = min(start + BLOCK_BYTES + 2, len(data))
        row = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(np.clip(off, start, stop)))
        yield data[start:stop], row, min(BLOCK_BYTES, stop - start)


def gram_codes(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, code) of all 1-, 2- and 3-grams of lower-cased bytes within texts, one n at a time."""
    for part, row, n in _windows(data, off):
        b = _fold[part].astype(np.uint32)
        yield row[:n], b[:n]
        if len(b) > 1:
            two = (b[:-1] << 8) | b[1:]
            inside = (row[:-1] == row[1:])[:n]
            yield row[: len(inside)][inside], two[:n][inside] + np.uint32(256)
            if len(b) > 2:
                three = (two[:-1] << 8) | b[2:]
                inside = (row[:-2] == row[2:])[:n]
                yield row[: len(inside)][inside], three[:n][inside] + np.uint32(256 + (1 << 16))


@dataclass(frozen=True)
class LanguageModel:
    """``grams``: codes that landmarks hold, sorted; ``landmarks``: their presences; ``weights``: per landmark and language."""

    languages: list[str]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def column_of(self) -> np.ndarray:
        """Column + 1 of every n-gram code, 0 for the others; untouched pages take no memory."""
        table = np.zeros(_N_CODES, np.uint16 if len(self.grams) < 1 << 16 else np.uint32)
        table[self.grams] = np.arange(1, len(self.grams) + 1)
        return table

    def presences(self, data: np.ndarray, off: np.ndarray, column_of: np.ndarray) -> np.ndarray:
        out = np.zeros((len(off) - 1, len(self.grams) + 1), np.float32)
        flat = out.reshape(-1)
        for row, code in gram_codes(data, off):
            flat[row.astype(np.int64) * out.shape[1] + column_of[code]] = 1
        return out[:, 1:]

    def kernel(self, present: np.ndarray) -> np.ndarray:
        size = np.maximum(present.sum(axis=1), 1)
        own = np.maximum(self.landmarks.sum(axis=1), 1)
        return (present @ self.landmarks.T) / np.sqrt(size)[:, None] / np.sqrt(own)[None, :]

    def decide(self, present: np.ndarray) -> np.ndarray:
        """One-versus-rest values, about 1 for the language and -1 for the rest."""
        return self.kernel(present) @ self.weights + self.bias


def _basis(languages: list[str], chosen: list[str]) -> tuple[LanguageModel, np.ndarray]:
    """A model of landmarks without weights, and the matrix that makes Nyström features of its kernel: K_xm K_mm^(-1/2)."""
    data, off = text_buffers(pa.array(chosen, pa.string()))
    codes = [np.unique(code) for _, code in gram_codes(data, off)]
    grams = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.uint32)
    bare = LanguageModel(languages, grams, np.zeros((0, len(grams)), np.float32), np.zeros((0, 0)), np.zeros(0))
    landmarks = bare.presences(data, off, bare.column_of())
    model = LanguageModel(languages, grams, landmarks, np.zeros((len(chosen), len(languages))), np.zeros(len(languages)))
    if not chosen:
        return model, np.zeros((0, 0))
    values, vectors = np.linalg.eigh(model.kernel(landmarks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    return model, vectors[:, keep] / np.sqrt(values[keep])


def _products(features: np.ndarray, language: np.ndarray, n_languages: int, weight: np.ndarray) -> np.ndarray:
    """Weighted products of (1, features) with (1, features, wanted values), which sum up over rows."""
    left = np.concatenate([np.ones((len(features), 1)), features], axis=1)
    wanted = np.where(language[:, None] == np.arange(n_languages)[None, :], 1.0, -1.0)
    return (left * weight[language][:, None]).T @ np.concatenate([left, wanted], axis=1)


def _solved(model: LanguageModel, root: np.ndarray, products: np.ndarray, n_rows: int, ridge: float) -> LanguageModel:
    """Ridge regression on the features, from the products of all rows; languages count alike."""
    d = root.shape[1]
    mean, target_mean = products[0, 1 : d + 1] / products[0, 0], products[0, d + 1 :] / products[0, 0]
    gram = products[1:, 1 : d + 1] - products[0, 0] * np.outer(mean, mean) + ridge * n_rows * np.eye(d)
    solved = np.linalg.solve(gram, products[1:, d + 1 :] - products[0, 0] * np.outer(mean, target_mean))
    return LanguageModel(
        model.languages, model.grams, model.landmarks, (root @ solved).astype(np.float32), (target_mean - mean @ solved).astype(np.float32)
    )


def _row_weights(counts: list[int]) -> np.ndarray:
    return sum(counts) / len(counts) / np.array(counts, float)


def fit(texts: list[str], langs: list[str], landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> LanguageModel:
    """From texts at hand. Landmarks are the first texts of every language; languages come in code point order."""
    languages = sorted(set(langs))
    by_language = {x: [t for t, y in zip(texts, langs) if y == x][:landmarks_per_language] for x in languages}
    model, root = _basis(languages, [t for x in languages for t in by_language[x]])
    if not texts:
        return model
    table, at = model.column_of(), np.array([languages.index(x) for x in langs])
    weight, total = _row_weights([langs.count(x) for x in languages]), 0.0
    for i in range(0, len(texts), BLOCK_TEXTS):
        data, off = text_buffers(pa.array(texts[i : i + BLOCK_TEXTS], pa.string()))
        features = model.kernel(model.presences(data, off, table)).astype(np.float64) @ root
        total = total + _products(features, at[i : i + BLOCK_TEXTS], len(languages), weight)
    return _solved(model, root, total, len(texts), ridge)


def _labelled(docs: DataFrame, fits: Column) -> DataFrame:
    """text, lang, key of the rows that fit and have both."""
    return docs.where(fits & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64("doc_id", F.lit("lang")).alias("key"))


def _numbered(rows: DataFrame, languages: list[str]) -> DataFrame:
    """text, language (its number) of the rows in one of ``languages``."""
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)])
    return rows.where(F.col("lang").isin(languages)).select("text", number[F.col("lang")].cast("int").alias("language"))


def learn(docs: DataFrame, fits: Column, landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> LanguageModel:
    """As ``fit``, from all rows that fit, by sums over them; of more than ``MOST_LANGUAGES`` languages the most frequent are learned.

    Landmarks, the basis of the features, are the first texts of every language
    in hashed order.
    """
    spark = ready(docs.sparkSession)
    usable = _labelled(docs, fits)
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()}
    languages = sorted(counts)
    if not languages:
        return fit([], [])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key", "text"))
    first = usable.where(F.col("lang").isin(languages)).withColumn("_at", place).where(F.col("_at") <= landmarks_per_language)
    model, root = _basis(languages, [r["text"] for r in sorted(first.collect(), key=lambda r: (r["lang"], r["_at"]))])
    weight = _row_weights([counts[x] for x in languages])
    held = spark.sparkContext.broadcast((model, root, weight))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, root, weight = held.value
        table, total = model.column_of(), None
        for batch, data, off in text_blocks(batches, "text", BLOCK_BYTES, BLOCK_TEXTS):
            features = model.kernel(model.presences(data, off, table)).astype(np.float64) @ root
            part = _products(features, batch.column("language").to_numpy(), len(model.languages), weight)
            total = part if total is None else total + part
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([task] * len(total), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                names=["row", "task", "products"],
            )

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in rows.sort_values("task")["products"])
        return pd.DataFrame({"row": rows["row"].iloc[:1], "products": [total.tobytes()]})

    parts = _numbered(usable, languages).mapInArrow(sums, "row int, task int, products binary")
    rows = parts.groupBy("row").applyInPandas(summed, "row int, products binary").collect()  # as many as features
    held.destroy()
    products = np.stack([np.frombuffer(r["products"]) for r in sorted(rows, key=lambda r: r["row"])])
    return _solved(model, root, products, sum(counts.values()), ridge)


def letter_trigrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, code) of the 3-grams of lower-cased bytes within texts that end in a letter or a byte beyond ASCII, in parts; other bytes are blanks."""
    for part, row, n in _windows(*text_buffers(pc.utf8_lower(texts))):
        b = _letter[part]
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        use = (row[:-2] == row[2:]) & (b[2:] != ord(" "))
        yield row[:-2][use], code[use]


@dataclass(frozen=True)
class Fluency:
    """``logs``: per 3-gram and language log10 of its last byte after its first two, and a last row for unseen ones; ``least``: thresholds."""

    grams: np.ndarray
    logs: np.ndarray
    least: np.ndarray

    def column_of(self) -> np.ndarray:
        """Row + 1 of every 3-gram, 0 for unseen ones, whose row is the last; untouched pages take no memory."""
        table = np.zeros(1 << 24, np.uint16 if len(self.grams) < 1 << 16 else np.uint32)
        table[self.grams] = np.arange(1, len(self.grams) + 1)
        return table

    def values(self, texts: pa.Array, language: np.ndarray, column_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean over the 3-grams of every text under its language, and their number; 0 and 0 where there are none."""
        n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for row, code in letter_trigrams(texts):
            n += np.bincount(row, minlength=len(texts))
            column = column_of[code].astype(np.int32) - 1
            total += np.bincount(row, weights=self.logs[column, language[row]], minlength=len(texts))
        return total / np.maximum(n, 1), n

    def fluent(self, texts: pa.Array, language: np.ndarray, column_of: np.ndarray) -> np.ndarray:
        """Not below the threshold by more than chance explains in so short a text."""
        value, n = self.values(texts, language, column_of)
        return (n == 0) | (value >= self.least[language] - SLACK / np.sqrt(np.maximum(n, 1)))


def learn_fluency(docs: DataFrame, fits: Column, held_out: Column, languages: list[str]) -> Fluency:
    """Counts 3-grams of all rows that fit and sets one threshold a language on all that are held out.

    It lies halfway between what nearly all held-out texts reach and what
    nearly none do once their letters are shuffled, and never above the former.
    A language without held-out texts has the lowest threshold of the others.
    3-grams that are as rare as unseen ones are not told from them.
    """
    spark = ready(docs.sparkSession)
    if not languages:
        return Fluency(np.zeros(0, np.uint32), np.full((1, 0), UNSEEN, np.float32), np.zeros(0))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in text_blocks(batches, "text", BLOCK_BYTES, BLOCK_TEXTS):
            language = batch.column("language").to_numpy().astype(np.int64)
            for row, code in letter_trigrams(batch.column("text")):
                found, n = np.unique((language[row] << 24) | code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["code", "n"])

    seen = _numbered(_labelled(docs, fits), languages).mapInArrow(codes, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    seen = written(seen.withColumn("prefix", F.shiftright("code", 8)), "trigrams")
    totals = seen.groupBy("prefix").agg(F.sum("n").alias("total"))
    share = F.log10(F.col("n") / F.col("total"))
    rows = seen.join(totals, "prefix").select("code", share.alias("share")).where(F.col("share") > UNSEEN).orderBy("code").collect()  # 3-grams of bytes
    code, value = np.array([r["code"] for r in rows], np.int64), np.array([r["share"] for r in rows], np.float32)
    grams = np.unique(code & 0xFFFFFF).astype(np.uint32)
    logs = np.full((len(grams) + 1, len(languages)), UNSEEN, np.float32)
    logs[np.searchsorted(grams, code & 0xFFFFFF), code >> 24] = value
    bare = Fluency(grams, logs, np.full(len(languages), -np.inf))
    held = spark.sparkContext.broadcast(bare)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bare = held.value
        table = bare.column_of()
        for batch, _, _ in text_blocks(batches, "text", BLOCK_BYTES, BLOCK_TEXTS):
            texts, language = batch.column("text"), batch.column("language").to_numpy()
            clean, n = bare.values(texts, language, table)
            shuffled = [_shuffled(t, np.random.default_rng(zlib.crc32(t.encode()))) for t in texts.to_pylist()]
            junk, m = bare.values(pa.array(shuffled, pa.string()), language, table)
            columns = [pa.array(language), pa.array(clean + SLACK / np.sqrt(np.maximum(n, 1)), mask=n == 0), pa.array(junk, mask=(m == 0) | (n == 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["language", "clean", "junk"])

    values = _numbered(_labelled(docs, held_out), languages).mapInArrow(judged, "language int, clean double, junk double")
    measures = [(F.col("clean"), (CLEAN_SHARE,), ("low",)), (F.col("junk"), (1 - CLEAN_SHARE,), ("high",))]
    for row in scope_statistics(written(values, "fluency"), ["language"], measures).collect():  # a row a language
        if row["low"] is not None:
            bare.least[row["language"]] = row["low"] if row["high"] is None else min(row["low"], (row["low"] + row["high"]) / 2)
    held.destroy()
    known = bare.least[np.isfinite(bare.least)]
    if len(known):
        bare.least[~np.isfinite(bare.least)] = known.min()
    return bare


_is_letter: list[np.ndarray] = []


def _shuffled(text: str, rng: np.random.Generator) -> str:
    """The same letters in places of letters, in another order."""
    if not _is_letter:
        _is_letter.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    out = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    places = np.flatnonzero(_is_letter[0][out])
    out[places] = out[rng.permutation(places)]
    return out.tobytes().decode("utf-32-le")


def training_sample(docs: DataFrame, fits: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """About ``per_language`` hashed (text, lang) of every language, at most twice as many, in a fixed order.

    Rows without text or language are left out; of more than ``MOST_LANGUAGES``
    languages the most frequent are learned.
    """
    usable = _labelled(docs, fits)
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, per_language / r["count"]))])
    chosen = usable.where(F.pmod("key", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    rows = chosen.orderBy("key", "text").limit(2 * per_language * len(counts)).collect()
    return [(r["text"], r["lang"]) for r in rows]


def identify(docs: DataFrame, model: LanguageModel, fluency: Fluency | None = None) -> DataFrame:
    """All columns of ``docs`` and lang_pred, score; with ``fluency``, which has the languages of ``model``, also fluent.

    ``score`` (0 to 1) is the value of the chosen language, 0.5 where no
    language is more likely than not. Null texts, texts without a letter, and
    all texts if no language was learned, are ``und`` with score 0 and not fluent.
    """
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast((model, fluency))  # landmarks x n-grams: bounded by the sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, fluency = held.value
        table = model.column_of()
        trigrams = fluency.column_of() if fluency else None
        for batch, data, off in text_blocks(batches, "_text", BLOCK_BYTES, BLOCK_TEXTS):
            values = model.decide(model.presences(data, off, table))
            best = values.argmax(axis=1)
            names = np.array([model.languages[k] for k in best], object)
            scores = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1).astype(np.float64)
            lettered = batch.column("_letter").to_numpy(zero_copy_only=False)
            names[~lettered], scores[~lettered] = UNDETERMINED, 0.0
            arrays, added = [pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"]
            if fluency:
                arrays.append(pa.array(fluency.fluent(batch.column("_text"), best, trigrams) & lettered))
                added.append("fluent")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *arrays], names=[*kept, *added])

    if not model.languages:
        none = {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)}
        return docs.withColumns(none | ({"fluent": F.lit(False)} if fluency else {}))
    kept = [f"_c{i}" for i in range(len(docs.columns))]  # own names: those of ``docs`` may clash
    rows = docs.toDF(*kept)
    at = kept[docs.columns.index("text")]
    lettered = F.coalesce(F.col(at).rlike(r"\p{L}"), F.lit(False))
    rows = rows.withColumns({"_text": F.coalesce(F.col(at), F.lit("")), "_letter": lettered})
    schema = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(kept, docs.schema.fields))
    found = rows.mapInArrow(score, f"{schema}, lang_pred string, score double" + (", fluent boolean" if fluency else ""))
    return found.withColumnsRenamed(dict(zip(kept, docs.columns)))
