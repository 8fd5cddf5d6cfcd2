"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismiq.session import fresh_path, table_path
from seismiq.sources.versions import delete

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark drop the shuffle files of each query as soon as it has ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    The files are on storage that every executor sees, so the loss of an
    executor costs no recomputation of what lies before the write.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{kind}")
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a materialised table that nothing will read any more."""
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        delete(table.sparkSession, folder)


ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """Texts may be long: Arrow batches of at most 8 MiB, whatever the number of rows.

    Sets the session's limit where it is larger (Spark's default is 64 MiB).
    """
    conf = df.sparkSession.conf
    if int(re.sub(r"[^0-9]", "", conf.get(ARROW_BYTES))) > BATCH_BYTES:
        conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return df


def slices(batch, rows: int = 256) -> Iterator:
    """Parts of an Arrow batch or array, so that few rows at a time become Python objects."""
    for i in range(0, max(1, len(batch)), rows):
        yield batch.slice(i, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def text_or_empty(name: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def sha256_hex(col: Column) -> Column:
    return F.lower(F.sha2(col, 256))
