"""Landed responses to bronze, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galecast.functions.clock import time_text
from galecast.sources.responses import explode_items, fill_cells, quarantine, request_cell, triage
from galecast.sources.tables import RUN_COLUMN


def landed_texts(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """A stream of response texts, one per file, with the file's path."""
    texts = (
        spark.readStream.option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path)
    )
    return texts.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"))


def items_with_run(responses: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of good responses, each under the run hour of its base time.

    The run follows from the item, not from the clock, so a replay lands every
    item where it landed before. The same function serves tables and streams.
    With a ``file`` column, items that do not name their cell take the one that
    was asked for, from the path.
    """
    carried = (*keep, "file") if "file" in responses.columns and "file" not in keep else keep
    items = explode_items(triage(responses, text), keep=carried)
    if "file" in carried:
        items = fill_cells(items, *request_cell(F.col("file")))
        items = items.withColumns({c: F.col(c).cast("string") for c in ("nx", "ny")})  # bronze items are text
        items = items if "file" in keep else items.drop("file")
    run = F.concat(F.col("baseDate"), F.substring(time_text(F.col("baseTime")), 1, 2))
    return items.withColumn(RUN_COLUMN, run)


def ingest_quarantine(responses: DataFrame, path: str, checkpoint: str, text: str = "text", once: bool = True) -> StreamingQuery:
    """Append the responses that gave neither items nor a plain "no data", with their status."""
    refused = quarantine(triage(responses, text)).drop("item_text")
    writer = refused.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest(
    responses: DataFrame, bronze: str, feed: str, checkpoint: str, text: str = "text",
    keep: tuple[str, ...] = (), once: bool = True,
) -> StreamingQuery:
    """Append the items to ``bronze/feed`` by run; with ``once`` until nothing new is left.

    The checkpoint records which files are done, and the file sink commits each
    batch once, so an interrupted ingest goes on without loss or repeats.
    """
    writer = (
        items_with_run(responses, text, keep)
        .writeStream.format("parquet")
        .partitionBy(RUN_COLUMN)
        .option("checkpointLocation", checkpoint)
        .option("path", f"{bronze}/{feed}")
        .outputMode("append")
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
