"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A number for the whole key. As the first column of a sort it decides nearly every comparison by itself,
# where a first key with few values leaves them to the whole rows.
KEY_HASH = "_key_hash"


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick, hashed: bool = False) -> DataFrame:
    rest = [c for c in order_by if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        once = df.select(*keys).distinct()
        return once.select(F.hash(*keys).alias(KEY_HASH), *keys) if hashed else once
    by = [KEY_HASH, *keys] if hashed else list(keys)
    placed = df.withColumn(KEY_HASH, F.hash(*keys)) if hashed else df
    kept = placed.groupBy(*by).agg(pick(F.struct(*rest)).alias("kept"))
    first = [KEY_HASH] if hashed else []
    return kept.select(*first, *[c if c in keys else F.col("kept").getField(c).alias(c) for c in df.columns])


def newest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), hashed: bool = False) -> DataFrame:
    """The row of each key that is largest by ``order_by``, then by all other columns.

    An aggregate of whole rows: each task first keeps one row per key, so a key
    that holds much of the table is already down to one row per task before the
    shuffle, and the result is known to be unique on the keys. Rows that tie in
    every column are the same row. With ``hashed`` rows are spread and sorted by
    ``KEY_HASH`` and the keys, and carry it in front, for joins on both.
    """
    return _one_per_key(df, keys, order_by, F.max, hashed)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row of each key that is smallest by ``order_by``, then by all other columns."""
    return _one_per_key(df, keys, order_by, F.min)


def newest_rows(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows that carry the largest ``by`` of their key.

    The maximum is an aggregate of its own with one row per key, so that no
    key has to be held, or sorted, in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(by).alias(by))
    return df.join(newest, [*keys, by], "left_semi").select(*df.columns)


def splittable(small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The small side of a join on ``keys``, placed apart from them.

    Spark splits a full partition of the large side only when both sides come
    straight from a shuffle for the join. After an aggregate on the join keys
    there would be none; spread by the keys as one value, the small side gets
    one. While it fits Spark's broadcast threshold it is broadcast all the same.
    """
    return small.repartition(F.struct(*keys))
