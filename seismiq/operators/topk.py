"""Top-k reports.  ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject:
each task keeps its own n best rows, only n rows per task reach the final
merge.  Every ordering ends in a unique key so results are deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: columns of the two reports ---------------------------------
TOP_EVENT_COLUMNS = ["event_id", "event_time_utc", "place", "magnitude", "severity",
                     "depth_category", "region", "alert_level", "tsunami_flag"]
TOP_INSIGHT_COLUMNS = ["event_hour", "severity", "region", "total_events", "avg_magnitude",
                       "max_magnitude", "tsunami_count", "most_notable_place"]
# --------------------------------------------------------------------------------


def _present(df: DataFrame, cols):
    out = []
    for c in cols:
        if c in df.columns:
            out.append(c)
        elif c == "event_time_utc" and "event_timestamp" in df.columns:
            out.append("event_timestamp")
    return out


def by_magnitude(df: DataFrame) -> DataFrame:
    """Strongest first; unknown magnitudes last; ties by event id."""
    return df.orderBy(F.col("magnitude").desc_nulls_last(), F.col("event_id").asc())


def top_events(silver: DataFrame, n: int = 11) -> DataFrame:
    return by_magnitude(silver).select(*_present(silver, TOP_EVENT_COLUMNS)).limit(n)


def top_insights(gold: DataFrame, n: int = 9) -> DataFrame:
    return (gold.orderBy(F.col("max_magnitude").desc_nulls_last(), F.col("event_hour").desc(),
                         "severity", "region")
                .select(*TOP_INSIGHT_COLUMNS).limit(n))


def ml_review(ml: DataFrame, n: int = 20) -> DataFrame:
    """ML table review: strongest events with actual vs predicted severity."""
    return (by_magnitude(ml)
            .select("event_id", "place", "magnitude",
                    F.col("severity").alias("actual_severity"),
                    "predicted_severity",
                    F.round(F.col("prediction_confidence") * 100, 1).alias("confidence_pct"),
                    "is_anomaly", "anomaly_reason", "region")
            .limit(n))
