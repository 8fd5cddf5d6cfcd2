"""Render bounded row sets as text inside Spark.

A text block is built from at most ``n`` rows chosen by a top-k
(TakeOrderedAndProject keeps n rows per task), so the one task that
concatenates lines never holds more than ``n`` rows, whatever the input size.
Blocks are scalar subqueries: the report row reads them as values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path


def fmt(c: Column | str) -> Column:
    """Value as text; null prints as ``None``."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(x.cast("string"), F.lit("None"))


def line(*parts: Column | str, sep: str = " | ") -> Column:
    return F.concat_ws(sep, *[fmt(p) for p in parts])


def lines_text(df: DataFrame, text: Column, order: Sequence[Column], n: int) -> Column:
    """Scalar subquery: the first ``n`` rows of ``df`` (by ``order``) as
    lines, or the empty string when ``df`` has no rows."""
    top = df.orderBy(*order).limit(n)
    ranked = top.select(F.row_number().over(Window.orderBy(*order)).alias("_rk"), text.alias("_line"))
    return ranked.agg(F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("_rk", "_line"))), lambda s: s["_line"]),
        "\n")).scalar()


def or_empty(body: Column, empty: str = "None") -> Column:
    """``empty`` in place of a text with no lines."""
    return F.when(body == F.lit(""), F.lit(empty)).otherwise(body)


def text_chunks(rows: DataFrame, text: Column, order: Sequence[Column], by: Sequence[str] = (), chunk_chars: int = 1 << 20,
                path: str | None = None) -> DataFrame:
    """The whole text of ``rows``, one line each in the given order, as numbered chunks: (*by, chunk, lines, content).

    The chunks of a text, in order and joined by a line break, are the text; a
    chunk ends with the line that reaches ``chunk_chars``, so no task holds more
    than that and a line.  ``by`` names the texts; ``order`` must tell all rows of
    one text apart.  Rows are range partitioned and written once (to ``path``); each
    range's length is added up, and a line's place in its text is the length of
    the ranges before it (a row for each range) plus a running sum within its own.
    """
    spark = rows.sparkSession
    path = path or fresh_path(spark, "text-lines")
    keys = [*[F.col(b) for b in by], *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*by, text.alias("_line"))
    ordered.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).write.parquet(path)
    lines = spark.read.parquet(path).withColumn("_size", F.length("_line") + 1)
    ranges = lines.groupBy(*by, "_range").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = Window.partitionBy(*by, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.join(ranges, [*by, "_range"]).withColumn("_start", F.col("_before") + F.coalesce(F.sum("_size").over(within), F.lit(0)))
    chunk = F.floor(F.col("_start") / chunk_chars).cast("long")
    return placed.groupBy(*by, chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_line"))), lambda s: s["_line"]), "\n").alias("content"))
