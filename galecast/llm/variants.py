"""Spelling variants: words one edit apart, found by dense tiles of common prefix and suffix lengths.

Two words differ by one inserted, deleted or replaced code point exactly when
their lengths differ by at most one and common prefix plus common suffix reach
the longer length minus one. So one of the two is at least half as long as the
longer word: words are dealt into groups of equal longer length L and equal
first (or last) L // 2 code points, and only within a group are blocks of words
compared, as padded matrices of code points, all pairs of a tile at once.
A group of more than ``SLICE`` words is cut into slices, and every pair of
slices is work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.session import ready, written

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
SLICE = 2048
TILE = 512
TILE_CELLS = 1 << 22
UNIT_WORDS = 20_000
PAIRS = "a string, a_n long, b string, b_n long"


def with_lost_letters(run: Column, doc_id: Column, every: int) -> Column:
    """The run, less one code point where ``every`` divides the CRC-32 of ``<doc_id>:<run>``; a null id is no digits."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", drop_every: int = DROP_EVERY) -> DataFrame:
    """word, n of all words that are long and frequent enough; only A-Z are lower-cased, null texts have no words."""
    runs = docs.select(
        F.col(doc_id).alias("_id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("_run"),
    ).where(F.length("_run") >= LEAST_LENGTH)
    words = runs.select(with_lost_letters(F.col("_run"), F.col("_id"), drop_every).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def code_points(words: list[str], backwards: bool) -> np.ndarray:
    """One row of code points per word, padded with 0 at the end; ``backwards`` from the last to the first."""
    if backwards:
        words = [w[::-1] for w in words]
    table = np.array(words, dtype=np.str_)
    return table.view(np.uint32).reshape(len(words), -1)


def common_lengths(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Common prefix length of every row of ``a`` with every row of ``b``, at most ``limit``."""
    total = np.zeros((len(a), len(b)), np.int32)
    running = np.ones(total.shape, bool)
    for c in range(min(a.shape[1], b.shape[1])):
        running &= a[:, c, None] == b[None, :, c]
        if not running.any():
            break
        total += running
    return np.minimum(total, limit)


class _Words:
    """Words of a group as matrices of both directions."""

    def __init__(self, words: list[str]):
        self.forward, self.backward = code_points(words, False), code_points(words, True)
        self.length = np.array([len(w) for w in words])

    def near(self, rows: slice, other: "_Words", columns: slice, suffix: bool, longer: int) -> np.ndarray:
        """Which pairs of a tile are one edit apart, have ``longer`` as greater length, and belong to this side.

        Pairs with half of the longer word in front belong to the prefix side.
        """
        a, b = self.length[rows][:, None], other.length[columns][None, :]
        limit, most = np.minimum(a, b), np.maximum(a, b)
        front = common_lengths(self.forward[rows], other.forward[columns], limit)
        back = common_lengths(self.backward[rows], other.backward[columns], limit)
        half = longer // 2
        side = (front < half) & (back >= half) if suffix else front >= half
        return side & (most == longer) & (most - limit <= 1) & (front + back >= most - 1)


def near_pairs(left: list[str], right: list[str] | None, suffix: bool, longer: int) -> Iterator[tuple[int, int]]:
    """Pairs (place in ``left``, place in ``right``) one edit apart; without ``right`` within ``left``, each once.

    All words are distinct and ``longer`` or one less long.
    """
    one = _Words(left)
    two = one if right is None else _Words(right)
    step = max(1, min(TILE, TILE_CELLS // max(1, longer)))
    for i in range(0, len(left), step):
        for j in range(i if right is None else 0, len(two.length), step):
            found = one.near(slice(i, i + step), two, slice(j, j + step), suffix, longer)
            for x, y in zip(*np.nonzero(found)):
                if right is not None or i + x < j + y:
                    yield int(i + x), int(j + y)


def _unit_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    for (_, suffix, longer, low, high), group in rows.groupby(["affix", "suffix", "longer", "low", "high"], sort=False):
        if len(group) < 2:
            continue
        words, counts = group["word"].tolist(), group["n"].tolist()
        if low == high:
            out += [(words[i], counts[i], words[j], counts[j]) for i, j in near_pairs(words, None, bool(suffix), int(longer))]
            continue
        first = (group["slice"] == low).to_numpy()
        here, there = np.flatnonzero(first), np.flatnonzero(~first)
        if len(here) and len(there):
            found = near_pairs([words[i] for i in here], [words[i] for i in there], bool(suffix), int(longer))
            out += [(words[here[i]], counts[here[i]], words[there[j]], counts[there[j]]) for i, j in found]
    return pd.DataFrame(out, columns=["a", "a_n", "b", "b_n"])


def near_words(words: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """a, a_n, b, b_n: every pair of words (word, n; distinct words) one edit apart, once."""
    spark = ready(words.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = max(partitions, words.count() * 4 // UNIT_WORDS)
    length = F.length("word")
    dealt = words.withColumn("longer", F.explode(F.array(length, length + 1))).withColumn("suffix", F.explode(F.array(F.lit(False), F.lit(True))))
    half = (F.col("longer") / 2).cast("int")
    affix = F.when(F.col("suffix"), F.substring("word", length - half + 1, half)).otherwise(F.substring("word", F.lit(1), half))
    dealt = dealt.withColumn("affix", F.xxhash64(affix, "longer", "suffix"))
    sizes = dealt.groupBy("affix").agg(F.count(F.lit(1)).alias("_size"), F.max(length == F.col("longer")).alias("_used"))
    sizes = sizes.where("_size > 1 and _used").select("affix", F.ceil(F.col("_size") / slice_size).cast("int").alias("slices"))
    work = dealt.join(sizes, "affix").withColumn("slice", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    work = work.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    low, high = F.least("slice", "other"), F.greatest("slice", "other")
    unit = F.when(F.col("slices") == 1, F.pmod("affix", F.lit(units))).otherwise(F.xxhash64("affix", low, high))
    work = work.select("word", "n", "affix", "suffix", "longer", "slice", low.alias("low"), high.alias("high"), unit.alias("unit"))
    # Dealt by number: the rows are small, the work on them is not.
    return work.repartition(units, "unit").groupBy("unit").applyInPandas(_unit_pairs, PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of every word that has a form: pointers are doubled until none moves; a round is stored."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = state.join(ahead, state["root"] == F.col("_word"), "left")
        moved = moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved"))
        state = written(moved, "roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", drop_every: int = DROP_EVERY, slice_size: int = SLICE
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the texts.

    ``form`` is the near word (one edit apart) of largest n, ties to the
    smallest in code point order, if that n is at least twice the word's; else
    null. ``root`` follows forms to the last; as n at least doubles with every
    step, there is no circle. Texts without words, and no rows, give no rows;
    rows that repeat count as often as they occur.
    """
    words = written(word_counts(docs, doc_id, text, drop_every), "words")
    pairs = near_words(words, slice_size)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )).alias("x")).select("x.*")
    best = both.groupBy(F.col("word").alias("_word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("_best")
    )
    joined = words.join(best, F.col("word") == F.col("_word"), "left")
    form_n = -F.col("_best")["col1"]
    follows = F.coalesce(form_n >= 2 * F.col("n"), F.lit(False))
    found = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(follows, F.col("_best")["other"]).alias("form"), F.when(follows, form_n).alias("form_n"),
    ), "forms")
    roots = _roots(found.where("form is not null")).withColumnRenamed("word", "_word")
    return found.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
