"""Whole-table profiles and validation rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gold import flag_count


def profile(bronze: DataFrame) -> DataFrame:
    """One-row profile of Bronze (duplicates kept).

    A global aggregate: partial aggregates per task, one final row.
    Event time is the feed's text column when present, else the parsed one.
    """
    tcol = "event_time_utc" if "event_time_utc" in bronze.columns else "event_timestamp"
    return bronze.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("event_id").alias("unique_events"),
        F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
        flag_count(F.col("tsunami_flag") == F.lit(True)).alias("tsunami_events"),
        F.min(tcol).alias("earliest_event"),
        F.max(tcol).alias("latest_event"),
    )


def silver_validation(silver: DataFrame) -> DataFrame:
    """Silver rollup by (severity, region), strongest first."""
    return (silver.groupBy("severity", "region")
                  .agg(F.count(F.lit(1)).alias("event_count"),
                       F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
                       F.max("magnitude").alias("max_magnitude"),
                       flag_count(F.col("tsunami_flag") == F.lit(True)).alias("tsunamis"))
                  .orderBy(F.col("max_magnitude").desc(), "severity", "region"))


def severity_distribution(df: DataFrame, col: str = "severity") -> DataFrame:
    """Row count per label (``value_counts``), most frequent first."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("events"))
              .orderBy(F.col("events").desc(), F.col(col)))
