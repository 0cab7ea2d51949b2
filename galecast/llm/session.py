"""What the operators need from the session: shared scratch tables and importable workers."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import galecast


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else one below the warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of ``df`` as a stored table; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_BYTES = 8 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, and bounds the bytes of a batch they get.

    Texts may be long: batches bounded by rows alone take much memory on both sides.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.abspath(galecast.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    return spark


def with_row_keys(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and a long column ``name`` that tells its rows apart, the same at every reading.

    It is the place of the row in its file; rows that come from no file are
    stored first.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name)
    try:
        return docs.select("*", place)
    except AnalysisException:
        return written(docs, "keyed").select("*", place)
