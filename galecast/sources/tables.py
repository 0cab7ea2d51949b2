"""Partitioned tables: scans of runs, dimension files, and the writes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galecast.sources.schemas import BASE_FEED, FEEDS

RUN_COLUMN = "dt"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the cluster names for checkpoints, else under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table of their own: worked out once, whatever reads them, and kept when executors are lost.

    It stays in the shared folder until that is cleaned.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table under a declared schema; without rows while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_run(
    spark: SparkSession,
    root: str,
    feed: str,
    run_dt: str | Sequence[str],
    schema: T.StructType | None = None,
    table_format: str = "parquet",
) -> DataFrame | None:
    """Rows of one feed for one run or several; None when there is no such run.

    Only a path that does not exist counts as absent. Any other fault of the
    read is raised. One run lists one folder, not the whole table. Whole
    numbers are read at 64 bits, which files may have, and then narrowed to the
    declared type; a number too large for it becomes null.
    """
    declared = FEEDS.get(feed) if schema is None else schema
    reader = spark.read.format(table_format).option("basePath", f"{root}/{feed}")
    if declared is not None:
        run = T.StructField(RUN_COLUMN, T.StringType())
        wide = [T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType) for f in declared.fields]
        reader = reader.schema(T.StructType([*wide, run]))

    def narrowed(df: DataFrame) -> DataFrame:
        if declared is None:
            return df
        whole = [f.name for f in declared.fields if f.dataType == T.IntegerType()]
        return df.withColumns({c: F.col(c).try_cast("int") for c in whole}) if whole else df

    runs = [run_dt] if isinstance(run_dt, str) else list(run_dt)
    try:
        if len(runs) == 1:
            return narrowed(reader.load(f"{root}/{feed}/{RUN_COLUMN}={runs[0]}"))
        return narrowed(reader.load(f"{root}/{feed}").where(F.col(RUN_COLUMN).isin(*runs)))
    except AnalysisException as fault:
        if fault.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_inventory(spark: SparkSession, path: str) -> DataFrame:
    """dt, stamp: the runs of a stored table and when their newest file was written, from the list of its files alone.

    A table that is not there has no runs.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        files = files.load(path)
    except AnalysisException as fault:
        if fault.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], f"{RUN_COLUMN} string, stamp long")
        raise
    run = F.regexp_extract("path", rf"/{RUN_COLUMN}=([^/]+)/", 1)
    return files.select(run.alias(RUN_COLUMN), F.unix_micros("modificationTime").alias("stamp")).groupBy(RUN_COLUMN).agg(F.max("stamp").alias("stamp"))


def runs_to_build(spark: SparkSession, bronze: str, silver: str) -> list[str]:
    """Runs whose base feed has landed and that are not in ``silver``, or landed again since they were built."""
    landed = run_inventory(spark, f"{bronze}/{BASE_FEED}")
    built = run_inventory(spark, silver).withColumnRenamed("stamp", "_built")
    due = landed.join(built, RUN_COLUMN, "left").where(F.col("_built").isNull() | (F.col("stamp") > F.col("_built")))
    return [r[0] for r in due.select(RUN_COLUMN).orderBy(RUN_COLUMN).collect()]  # a row a run


def scan_feeds(spark: SparkSession, root: str, run_dt: str | Sequence[str]) -> dict[str, DataFrame | None]:
    """All feeds of a run or several; each run must have the base feed."""
    runs = [run_dt] if isinstance(run_dt, str) else list(run_dt)
    missing = [run for run in runs if scan_run(spark, root, BASE_FEED, run) is None]
    if missing:
        raise FileNotFoundError(f"no {BASE_FEED} for run {', '.join(missing)} under {root}")
    return {feed: scan_run(spark, root, feed, run_dt) for feed in FEEDS}


def read_table(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """A stored table whose run column is text, whatever its values look like as a partition."""
    schema = spark.read.format(table_format).load(path).schema
    if table_format != "parquet" or RUN_COLUMN not in schema.names:
        return spark.read.format(table_format).load(path)
    text = [T.StructField(f.name, T.StringType()) if f.name == RUN_COLUMN else f for f in schema.fields]
    return spark.read.schema(T.StructType(text)).parquet(path)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A small table kept as Parquet, or as CSV with a header (byte-order mark allowed).

    CSV columns are matched to the header by name; without a schema they are text.
    """
    if path.rstrip("/").lower().endswith(".parquet"):
        return spark.read.parquet(path)
    text = spark.read.option("header", True).csv(path)
    clean = text.toDF(*[c.lstrip("﻿").strip() for c in text.columns])
    if schema is None:
        return clean
    return clean.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in clean.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    table_format: str = "parquet",
    sort_by: Sequence[str] = (),
) -> None:
    """Write a table; an overwrite replaces only the partitions it brings.

    So a rerun of a run hour is idempotent and other runs stay. Rows are
    gathered by partition value before the write, and a partition that is too
    large for one task is split, so neither many small files nor one huge task
    arises.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    writer = out.write.format(table_format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def land_feed(df: DataFrame, root: str, feed: str, run_dt: str | None = None, mode: str = "overwrite") -> None:
    """Put one feed's rows under its run; ``run_dt`` None keeps the ``dt`` of the rows."""
    rows = df if run_dt is None else df.withColumn(RUN_COLUMN, F.lit(run_dt))
    order = [c for c in ("fcstDate", "fcstTime", "nx", "ny") if c in rows.columns]
    write_table(rows, f"{root}/{feed}", [RUN_COLUMN], mode, sort_by=[RUN_COLUMN, *order])


def land_feeds(feeds: dict[str, DataFrame | None], root: str, run_dt: str) -> list[str]:
    """Land the feeds that are there; returns their names."""
    landed = [name for name, df in feeds.items() if df is not None]
    for name in landed:
        land_feed(feeds[name], root, name, run_dt)
    return landed


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in ``buckets`` by ``keys``, sorted within them.

    Tables in as many buckets by the same keys are joined and aggregated by
    them without a shuffle, as often as they are read.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    name = os.path.basename(path).replace("-", "_")
    rows = df.repartition(buckets, *keys)  # a bucket is one file
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def interleaved(columns: Sequence[Column], bits: int = 16) -> Column:
    """The low ``bits`` of whole numbers interleaved, first column lowest: near in all columns is near in one order.

    Negative numbers and nulls count as 0.
    """
    out = F.lit(0).cast("long")
    for k, column in enumerate(columns):
        value = F.greatest(F.coalesce(column.cast("long"), F.lit(0)), F.lit(0))
        for i in range(bits):
            bit = F.shiftright(value, i).bitwiseAND(F.lit(1))
            out = out + F.shiftleft(bit, i * len(columns) + k)
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[Column], files: int, mode: str = "overwrite") -> None:
    """Write ``files`` files along the interleaved order of ``columns``.

    A box in these columns then lies in few files, which the statistics in
    their footers tell, so a reader skips the others.
    """
    placed = df.withColumn("_z", interleaved(columns))
    placed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").write.mode(mode).parquet(path)
