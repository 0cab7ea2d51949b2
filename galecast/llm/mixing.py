"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, gone through
``epochs`` times. A copy of a document leaves its queue at the virtual finish
time (words of the source up to its end) / (target of the source); the mix is
all copies in the order of these times, cut where the budget is reached.

Running sums are taken in levels (hash bucket, bucket in bucket, rows), so
neither a source with most of the rows nor the whole mix is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galecast.llm.session import with_row_keys, written

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
TIME_BINS = 1 << 14
ORDER = ["key", "doc_id", "size", "row"]


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """One row per source: source, rank, source_size, target.

    Sources in code point order, null last, take the weights in turn. Targets
    share ``share`` times all sizes by weight; none exceeds ``epochs`` times
    its source, and what is cut there goes to the others by weight. With
    sources by the ratio of limit to weight, that is one running sum: the
    first ones are held at their limits, the others get one rate.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    ordered = each.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    held = ordered.withColumn("w", weight).withColumn("limit", (F.col("source_size") * epochs).cast("double"))
    up_to = Window.orderBy((F.col("limit") / F.col("w")).asc(), "rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = (
        held.withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("limits_before", F.coalesce(F.sum("limit").over(up_to), F.lit(0.0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(up_to), F.lit(0.0)))
        .withColumn("w_all", F.sum("w").over(everything))
        .withColumn("rate", (F.col("budget") - F.col("limits_before")) / (F.col("w_all") - F.col("w_before")))
        .withColumn("free", F.col("rate") * F.col("w") <= F.col("limit"))
        .withColumn("free_rate", F.max(F.when(F.col("free"), F.struct(-F.col("w_before"), F.col("rate")))).over(everything)["rate"])
    )
    target = F.when(F.col("free_rate").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("free_rate") * F.col("w")))
    return rest.select("source", "rank", "source_size", target.alias("target"))


def _running(df: DataFrame, keys: list[str], order: list[Column | str], value: str, out: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(window))


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, of which ``source`` may be null."""
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    found = F.lit(True)
    for k in keys:
        found &= F.col(k).eqNullSafe(F.col(f"_{k}")) if k == "source" else F.col(k) == F.col(f"_{k}")
    return left.join(named, found).drop(*[f"_{k}" for k in keys])


def _queued(docs: DataFrame, seed: str, row: Column) -> DataFrame:
    """doc_id, source, size, key, row and hash buckets of all rows; stored, so that texts are read once."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"),
        row.alias("row"),
    ).withColumn("b1", F.substring("key", 1, 2)).withColumn("b2", F.substring("key", 3, 2))
    return written(rows, "sizes")


def _placed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds rank, source_size, target and ``end``, the words of the source up to the end of the row."""
    inner = rows.groupBy("source", "b1", "b2").agg(F.sum("size").alias("words"))
    outer = inner.groupBy("source", "b1").agg(F.sum("words").alias("words"))
    outer = _running(outer, ["source"], ["b1"], "words", "end1").withColumn("start1", F.col("end1") - F.col("words"))
    inner = _running(inner, ["source", "b1"], ["b2"], "words", "end2").withColumn("start2", F.col("end2") - F.col("words"))

    inner = _matched(inner, outer.select("source", "b1", "start1"), ["source", "b1"])
    inner = inner.withColumn("start", F.col("start1") + F.col("start2"))
    inner = _matched(inner, targets, ["source"]).drop("words", "end2", "start1", "start2")
    placed = _matched(rows, inner, ["source", "b1", "b2"])
    placed = _running(placed, ["rank", "b1", "b2"], ORDER, "size", "within")
    return written(placed.withColumn("end", F.col("start") + F.col("within")), "placed")


def _finish(epoch: Column) -> Column:
    return (F.col("end") + epoch * F.col("source_size")) / F.col("target")


def _border(placed: DataFrame, targets: DataFrame, epochs: int) -> DataFrame:
    """One row: ``at``, the place at which the budget ends and the part taken there; null where all copies are taken."""
    copies = placed.where("target > 0 and size > 0").select(
        "rank", "end", "size", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    ).select("rank", "end", "size", "epoch", _finish(F.col("epoch")).alias("finish"))
    copies = copies.withColumn("bin", F.least(F.floor(F.col("finish") * (TIME_BINS // 2)), F.lit(TIME_BINS)))
    bins = copies.groupBy("bin").agg(F.sum("size").alias("words"))
    bins = _running(bins, [], ["bin"], "words", "reached")
    budget = targets.agg(F.floor(F.sum("target") + F.lit(1e-6)).alias("budget"))
    cut_bin = bins.join(budget, F.col("reached") > F.col("budget"), "inner").agg(F.min("bin").alias("cut_bin"))
    before = bins.join(cut_bin, (F.col("bin") < F.col("cut_bin")) | F.col("cut_bin").isNull(), "inner").agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("before")
    )
    # Only the copies of the one bin in which the budget ends are put in exact order.
    last = copies.join(F.broadcast(cut_bin), copies["bin"] == F.col("cut_bin")).select("rank", "end", "size", "epoch", "finish")
    last = _running(last, [], ["finish", "rank", "epoch", "end", "size"], "size", "reached")
    return (
        last.crossJoin(F.broadcast(before.crossJoin(budget)))  # one row
        .where("before + reached > budget")
        .agg(F.min(F.struct("finish", "rank", "epoch", "end", (F.col("budget") - F.col("before") - F.col("reached") + F.col("size")).alias("part"))).alias("at"))
    )


def _edge(epoch: int) -> tuple[Column, Column]:
    """Whether a copy comes before the border, and whether it is the one at the border."""
    place = F.struct(_finish(F.lit(epoch)).alias("finish"), F.col("rank"), F.lit(epoch).alias("epoch"), F.col("end"))
    edge = F.struct("at.finish", "at.rank", "at.epoch", "at.end")
    return F.col("at").isNull() | (place < edge), place == edge


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = "mix"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken.

    ``size`` is the number of words (null text: 0), ``taken`` the words that
    the mix takes, repeats counted: whole copies, but for the one at which the
    budget ends. Null is a source like any other. The order within a source is
    by a hash of ``seed`` and doc_id, then size; rows equal in all these are
    interchangeable. An empty table, or one without words, takes nothing.
    """
    rows = _queued(docs, seed, F.lit(0).cast("long"))
    targets = written(source_targets(rows, weights, share, epochs), "targets")
    placed = _placed(rows, targets)
    whole = placed.crossJoin(F.broadcast(_border(placed, targets, epochs)))  # one row
    taken = F.lit(0).cast("long")
    for epoch in range(epochs):
        before, at = _edge(epoch)
        taken = taken + F.when(before, F.col("size")).when(at, F.col("at.part")).otherwise(0)
    taken = F.when((F.col("target") > 0) & (F.col("size") > 0), taken).otherwise(0).cast("long")
    return whole.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = "mix"
) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: each as often as the mix takes it whole.

    A document cut at the end of the budget is not taken; one without words
    takes no part in the mix and is left out. In every round the mix takes the
    first rows of a source, so where the last one lies tells of every row how
    often it is taken, and no text is shuffled. Rows that repeat an id are told
    apart by their places in the stored table.
    """
    own = [f"_d{i}" for i in range(len(docs.columns))]  # own names: those of ``docs`` may clash
    named = dict(zip(docs.columns, own))
    keyed = with_row_keys(docs, "_row").toDF(*own, "row")
    keyed = keyed.withColumns({c: F.col(named[c]) for c in ("doc_id", "source", "text")})
    rows = _queued(keyed, seed, F.col("row"))
    targets = written(source_targets(rows, weights, share, epochs), "targets")
    placed = _placed(rows, targets)
    whole = placed.where("target > 0 and size > 0").crossJoin(F.broadcast(_border(placed, targets, epochs)))  # one row
    last = [F.max(F.when(_edge(epoch)[0], F.struct(*ORDER))).alias(f"_last{epoch}") for epoch in range(epochs)]
    lasts = written(whole.groupBy(F.col("source").alias("_source")).agg(*last), "lasts")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    joined = keyed.withColumns({"size": size, "key": key}).where("size > 0").join(lasts, F.col("source").eqNullSafe(F.col("_source")))
    times = sum((F.coalesce((F.struct(*ORDER) <= F.col(f"_last{epoch}")).cast("int"), F.lit(0)) for epoch in range(epochs)), F.lit(0))
    return (
        joined.withColumn("_times", times).where("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*own).toDF(*docs.columns)
    )
