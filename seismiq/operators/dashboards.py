"""Datasets behind the dashboard visuals (one small rollup each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .topk import by_magnitude


def events_by_severity(gold: DataFrame) -> DataFrame:
    return gold.groupBy("severity").agg(F.sum("total_events").alias("total_events"))


def max_magnitude_by_region(gold: DataFrame) -> DataFrame:
    return gold.groupBy("region").agg(F.max("max_magnitude").alias("max_magnitude"))


def anomaly_counts(ml: DataFrame) -> DataFrame:
    return ml.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("events"))


def predicted_counts(ml: DataFrame) -> DataFrame:
    return ml.groupBy("predicted_severity").agg(F.count(F.lit(1)).alias("events"))


def hourly_activity(gold: DataFrame) -> DataFrame:
    return gold.groupBy("event_hour").agg(F.sum("total_events").alias("total_events"))


def report_table(history: DataFrame) -> DataFrame:
    return history.select("output_type", "content")


def top_event_table(silver: DataFrame, n: int = 10) -> DataFrame:
    return by_magnitude(silver).select("place", "magnitude", "severity").limit(n)
