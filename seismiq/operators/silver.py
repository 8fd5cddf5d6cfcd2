"""Silver layer: latest version per event, parsed time, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.timefmt import parse_iso_utc
from ..sources.schemas import SILVER_COLUMNS
from .dedup import BRONZE_ORDER, dedup_latest


def classify(df: DataFrame) -> DataFrame:
    """Add ``event_timestamp``, ``severity``, ``depth_category``, ``region``;
    fill ``alert_level``.  One projection, no shuffle."""
    cols = {
        "severity": labels.severity("magnitude"),
        "depth_category": labels.depth_category("depth_km"),
        "alert_level": labels.alert_level("alert_level"),
        "region": labels.region("latitude", "longitude"),
    }
    if "event_timestamp" not in df.columns and "event_time_utc" in df.columns:
        cols["event_timestamp"] = parse_iso_utc("event_time_utc")
    return df.withColumns(cols)


def project_silver(latest: DataFrame, stamp: bool = True) -> DataFrame:
    """Latest versions -> Silver columns; a projection.

    ``stamp`` adds ``silver_load_timestamp``; oracle-checked queries leave it
    out because it is the wall clock of the run.
    """
    df = classify(latest)
    if stamp:
        df = df.withColumn("silver_load_timestamp", F.current_timestamp())
    return df.select(*[c for c in SILVER_COLUMNS if c in df.columns])


def silver(bronze: DataFrame, order: Sequence[str] = BRONZE_ORDER,
           stamp: bool = True) -> DataFrame:
    """Bronze rows -> Silver table (Silver projection of the columns present)."""
    return project_silver(dedup_latest(bronze, "event_id", order), stamp)
