"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Rows of a length that no other row has need no prefix hash, and rows of a
length and prefix hash that no other row has need no full hash. Which groups
survive a level is told to the next scan by a bitmap of fixed size (1 MB), so
no text is shuffled to compare it, and a row that passes by chance is only hashed in vain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_BITS = 1 << 23
PAGE_BITS = 32768  # of bitmap_construct_agg
PREFIX_CHARS = 128


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(MAP_BITS))


def _surviving(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmap pages of the groups with more than one row: at most 256 rows of 4 KB at any input size."""
    return marked_pages(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), keys)


def marked_pages(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmap pages of the keys in ``rows``: at most 256 rows of 4 KB at any input size."""
    slots = rows.select(_slot(keys).alias("_slot")).distinct()
    return (
        slots.groupBy(F.floor(F.col("_slot") / PAGE_BITS).alias("_page"))
        .agg(F.bitmap_construct_agg(F.col("_slot") % PAGE_BITS).alias("_bits"))
    )


def with_flag(rows: DataFrame, pages: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Adds whether a row's group may have survived; ``pages`` has a proven bound and is broadcast."""
    slot = rows.withColumn("_slot", _slot(keys)).withColumn("_page", F.floor(F.col("_slot") / PAGE_BITS))
    bit = F.col("_slot") % PAGE_BITS
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = slot.join(F.broadcast(pages), "_page", "left")
    is_set = F.coalesce(F.expr("shiftright({}, {}) & 1".format("_byte", "_at")) == 1, F.lit(False))
    return (
        joined.withColumn("_byte", byte).withColumn("_at", (bit % 8).cast("int")).withColumn(flag, is_set)
        .drop("_slot", "_page", "_bits", "_byte", "_at")
    )


def _refined(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with _text, _len, _same_length, _head, _same_head; rows without both flags have no equal."""
    base = docs.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).withColumn("_len", F.octet_length("_text"))
    by_length = _surviving(base, ["_len"])
    second = with_flag(base, by_length, ["_len"], "_same_length").withColumn(
        "_head", F.when(F.col("_same_length"), F.xxhash64(F.substring("_text", 1, PREFIX_CHARS)))
    )
    by_head = _surviving(second.where("_same_length"), ["_len", "_head"])
    return with_flag(second, by_head, ["_len", "_head"], "_same_head")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, full), (groups: full, keep_id, group_size).

    ``full`` is the SHA-256 of the text for rows that may have an equal, null
    for the others, which have none. Null text counts as empty. ``keep_id`` is
    the largest id of the group; null ids come last. Rows that repeat id and
    text count as copies of each other and stay or go together.
    """
    third = _refined(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    rows = third.select(
        "doc_id", F.when(F.col("_same_length") & F.col("_same_head"), F.sha2("_text", 256)).alias("full"), "_text"
    )
    groups = (
        rows.where("full is not null").groupBy("full")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    )
    return rows, groups


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    An empty table gives no rows; other columns of ``docs`` play no part.
    """
    rows, groups = exact_groups(docs, doc_id, text)
    # The digest of rows without an equal is part of the result, not of the search.
    each = rows.select("doc_id", F.coalesce("full", F.sha2("_text", 256)).alias("text_sha256"))
    found = each.join(groups.withColumnRenamed("full", "text_sha256"), "text_sha256", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def comparable(docs: DataFrame) -> list[str]:
    """The columns that can be hashed, which maps cannot."""
    return [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: exactly one of each group of equal texts.

    It is the one with the largest id; null ids come last, and of rows that
    repeat the id one stays. Only texts of rows that may have an equal are
    shuffled, and every task keeps one row of a group before that.
    """
    own = [f"_d{i}" for i in range(len(docs.columns))]  # own names: those of ``docs`` may clash
    named = dict(zip(docs.columns, own))
    rows = _refined(docs.toDF(*own), named[text])
    maybe = F.col("_same_length") & F.col("_same_head")
    order = F.struct(F.col(named[doc_id]), F.xxhash64(*[named[c] for c in comparable(docs)]))
    kept = rows.where(maybe).groupBy(F.sha2("_text", 256)).agg(F.max_by(F.struct(*own), order).alias("_row")).select("_row.*")
    return rows.where(~maybe).select(*own).unionByName(kept).toDF(*docs.columns)
