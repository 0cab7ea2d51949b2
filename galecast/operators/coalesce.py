"""Left joins in which the right side only fills what the left side lacks."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.operators.keys import KEY_HASH, newest_per_key, splittable

log = logging.getLogger(__name__)

KEYS = ("nx", "ny", "fcstDate", "fcstTime")


@dataclass(frozen=True)
class Feed:
    """A right side: the columns it may fill, and what makes a row the newest of its key."""

    name: str
    rows: DataFrame | None
    columns: Sequence[str]
    order_by: Sequence[str] = ("baseDate", "baseTime")


def _usable(feed: Feed, keys: Sequence[str]) -> bool:
    if feed.rows is None:
        return False
    missing = [k for k in keys if k not in feed.rows.columns]
    if missing:
        log.warning("feed %s skipped: it lacks %s", feed.name, ", ".join(missing))
    return not missing


def merge_feeds(
    base: DataFrame, feeds: Sequence[Feed], keys: Sequence[str] = KEYS, unique_base: bool = False,
    unique_feeds: bool = False,
) -> DataFrame:
    """Left-join the feeds on ``keys``, in order; the base value wins, then the first feed's.

    A feed that is absent or lacks a key changes nothing. With ``unique_base``
    the base has one row per key: every side is shuffled once, by the same keys,
    for all joins. A base that may repeat a key many times needs a second
    shuffle of the (smaller) feeds, so that Spark can split its full partitions.
    With ``unique_feeds`` the feeds are known to have one row per key as well.
    A unique base that carries the hash of its keys is joined by both.
    """
    usable = [f for f in feeds if _usable(f, keys)]
    hashed = unique_base and not unique_feeds and KEY_HASH in base.columns
    on = [KEY_HASH, *keys] if hashed else list(keys)
    joined = base.select(*on, *[F.col(c).alias(f"base.{c}") for c in base.columns if c not in on])
    sources = {c: [f"base.{c}"] for c in base.columns if c not in on}
    for i, feed in enumerate(usable):
        fill = [c for c in feed.columns if c in feed.rows.columns and c not in keys]
        order = [c for c in feed.order_by if c in feed.rows.columns and c not in keys]
        wanted = list(dict.fromkeys([*keys, *order, *fill]))
        right = feed.rows if unique_feeds else newest_per_key(feed.rows.select(*wanted), keys, order, hashed)
        right = right.select(*on, *[F.col(c).alias(f"{i}.{c}") for c in fill])
        joined = joined.join(right if unique_base else splittable(right, keys), on, "left")
        for c in fill:
            sources.setdefault(c, []).append(f"{i}.{c}")
    filled = [
        (F.coalesce(*[F.col(f"`{s}`") for s in names]) if len(names) > 1 else F.col(f"`{names[0]}`")).alias(c)
        for c, names in sources.items()
    ]
    return joined.select(*keys, *filled)


def coalesce_join(
    base: DataFrame,
    right: DataFrame | None,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    order_by: Sequence[str] = ("baseDate", "baseTime"),
) -> DataFrame:
    """One such join: as many rows as the base has."""
    return merge_feeds(base, [Feed("right", right, columns, order_by)], keys)
