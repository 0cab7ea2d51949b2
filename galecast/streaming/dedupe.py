"""Repeated items of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galecast.operators.coalesce import KEYS
from galecast.operators.keys import newest_per_key
from galecast.sources.tables import read_or_empty, stored, write_table


def drop_repeats(
    stream: DataFrame, event_time: str, delay: str = "2 days", keys: Sequence[str] = (*KEYS, "category")
) -> DataFrame:
    """The first item per key as long as repeats come within ``delay`` of each other.

    Rows behind the watermark are dropped, and of repeats the first to arrive
    stays. Where the newest value must win, or nothing may be lost, use
    ``keep_newest``, or ``append_items`` and ``newest_items``.

    ``event_time`` is a timestamp column, such as ``clock.on_axis`` of the valid time.

    State is kept per key until the watermark has passed it, so it is bounded by
    the keys of one delay, not by the length of the stream.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def newest_by_key(
    stream: DataFrame, keys: Sequence[str], order_by: Sequence[str], window: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """A stream of the newest row of each key among those that arrived in the same window; in update mode, those a batch changed.

    The watermark is on the time of arrival, which only moves on: no row is
    dropped, and the state holds the keys of the windows still open.
    """
    rest = [c for c in order_by if c not in keys] + [c for c in stream.columns if c not in keys and c not in order_by]
    timed = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    kept = timed.groupBy(F.window("_arrived", window).alias("_at"), *keys).agg(F.max(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col("_kept").getField(c).alias(c) for c in stream.columns])


def upsert_newest(changed: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str], slot: str) -> None:
    """Bring rows into a table with one row per key; the newest stays, and only the touched ``slot`` partitions are read and written.

    The same rows brought twice change nothing.
    """
    spark = changed.sparkSession
    new = stored(changed, "newest")
    slots = [r[0] for r in new.select(slot).distinct().collect()]  # one row a partition of the batch
    if not slots:
        return
    known = [x for x in slots if x is not None]
    touched = F.col(slot).isin(known) if known else F.lit(False)
    if None in slots:
        touched = touched | F.col(slot).isNull()
    have = read_or_empty(spark, path, new.schema).where(touched)
    write_table(stored(newest_per_key(have.unionByName(new), keys, order_by), "newest"), path, [slot])


def keep_newest(
    stream: DataFrame, path: str, checkpoint: str, order_by: Sequence[str], keys: Sequence[str] = (*KEYS, "category"),
    slot: str = "fcstDate", window: str = "1 hour", delay: str = "10 minutes", once: bool = True,
) -> StreamingQuery:
    """A table with the newest row of each key, kept up to date as rows arrive, late or repeated."""
    writer = (
        newest_by_key(stream, keys, order_by, window, delay).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda changed, _: upsert_newest(changed, path, keys, order_by, slot))
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_items(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Store every item as it arrives, late or repeated; each batch is committed once."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def newest_items(
    stored: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (*KEYS, "category")
) -> DataFrame:
    """One item per key of what ``append_items`` stored: the newest, as in the batch jobs."""
    return newest_per_key(stored, keys, order_by)
