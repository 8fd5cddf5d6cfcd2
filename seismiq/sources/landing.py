"""NDJSON landing zone: write batches, list files, batch-read with a schema."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import FEED_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def landing_glob(landing: str) -> str:
    """Every landed file: ``<landing>/<batch>/<part>.json``."""
    return f"{landing.rstrip('/')}/*/*.json"


def land(feed: DataFrame, landing: str, batch: str | None = None) -> str:
    """Write one landing batch of feed records as JSON lines.

    Each batch goes to its own new directory (time-stamped and unique), so a
    file name is never reused: the stream source tracks files by path and
    would ignore a rewritten file.  Executors write their partitions in
    parallel; nothing passes through the driver.
    """
    name = batch or f"earthquakes_{time.strftime('%Y%m%d_%H%M%S', time.gmtime())}_{uuid.uuid4().hex[:8]}"
    out = f"{landing.rstrip('/')}/{name}"
    feed.write.mode("error").json(out)
    return out


def land_by(feed: DataFrame, landing: str, batch: str) -> str:
    """Land the feed at once, a folder for each value of the column ``batch``.

    The rebalance sizes files by bytes: a large batch is split over several
    tasks, rows of one key (or without one) are never gathered.
    """
    rows = feed.withColumn(batch, F.coalesce(F.col(batch).cast("string"), F.lit("unknown")))
    rows.hint("rebalance", batch).write.mode("error").partitionBy(batch).json(landing)
    return landing


def list_landing(spark: SparkSession, landing: str) -> DataFrame:
    """Landed files with name, size and modification time.

    Only the file metadata columns are selected, so file contents are never
    read.  Zero-length files (no records) are skipped by the file scan.
    """
    return (spark.read.format("binaryFile")
                 .option("pathGlobFilter", "*.json")
                 .option("recursiveFileLookup", "true")
                 .load(landing)
                 .select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                         F.col("length").alias("size_bytes"),
                         F.col("modificationTime").alias("modified_at"),
                         "path"))


def read_landing(spark: SparkSession, landing: str, corrupt: bool = False) -> DataFrame:
    """Batch read of landed records with the fixed schema (PERMISSIVE).

    A wrong-typed field becomes null; with ``corrupt=True`` the raw text of a
    malformed line is kept in ``_corrupt_record``.
    """
    schema = FEED_SCHEMA
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt:
        schema = T.StructType(FEED_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).json(landing_glob(landing))


SIDES = ("good", "corrupt")


def split_landing(spark: SparkSession, files: str, root: str) -> dict[str, int]:
    """Read the JSON lines of ``files`` once and write records to ``root/side=good``, malformed lines to ``root/side=corrupt``.

    A line is malformed if it is no JSON, is cut off, or holds a value of the
    wrong type; it goes to its side as a whole, with the file it came from.
    Returns the number of lines on each side, counted during the write.
    """
    schema = T.StructType(FEED_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    lines = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(files)
             .withColumn("source_file", F.col("_metadata.file_path")))
    bad, counted = F.col(CORRUPT_COLUMN).isNotNull(), Observation("split_landing")
    sides = lines.withColumn("side", F.when(bad, SIDES[1]).otherwise(SIDES[0])).observe(
        counted, F.count_if(~bad).alias(SIDES[0]), F.count_if(bad).alias(SIDES[1]))
    sides.write.partitionBy("side").parquet(root)
    return {side: int(counted.get[side]) for side in SIDES}


def read_good(spark: SparkSession, root: str) -> DataFrame:
    """The records of a split landing."""
    return _read_side(spark, root, "good").drop(CORRUPT_COLUMN)


def read_corrupt(spark: SparkSession, root: str) -> DataFrame:
    """The malformed lines of a split landing: (line, source_file)."""
    return _read_side(spark, root, "corrupt").select(F.col(CORRUPT_COLUMN).alias("line"), "source_file")


def _read_side(spark: SparkSession, root: str, side: str) -> DataFrame:
    fields = [*FEED_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType()), T.StructField("source_file", T.StringType()), T.StructField("side", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(root).where(F.col("side") == side).drop("side")
