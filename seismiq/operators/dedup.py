"""Latest-version deduplication (one row per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import parse_iso_utc

# Tie-breakers used when several versions share one load time (all rows of
# one micro-batch carry the same load stamp).
BRONZE_ORDER = ["bronze_load_timestamp", "ingestion_timestamp_utc", "source_file"]


# Held as feed text: compared as a time first, since text with a fraction
# sorts before the same second without one.
TIME_TEXT = "ingestion_timestamp_utc"


def version_order(order: Sequence[str]) -> list[Column]:
    """The values that order the versions of an event, larger is later."""
    return [c for name in order
            for c in ((parse_iso_utc(name), F.col(name)) if name == TIME_TEXT else (F.col(name),))]


def dedup_latest(df: DataFrame, key: str = "event_id",
                 order: Sequence[str] = BRONZE_ORDER) -> DataFrame:
    """Keep the latest version of each ``key``; rows with a null key are dropped.

    ``row_number() = 1`` over ``partition by key order by order... desc``.
    Spark plans this with a *partial* WindowGroupLimit before the shuffle, so
    each map task forwards at most one row per key: a key holding a third of
    all rows costs one row per input split, not a third of the data in one
    task.  The null-key filter reaches the scan where the key is a stored
    column (on the test adapter it is derived, so it runs after the scan).
    """
    order = [c for c in order if c in df.columns]
    w = Window.partitionBy(key).orderBy(*[c.desc_nulls_last() for c in version_order(order)])
    return (df.filter(F.col(key).isNotNull())
              .withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
