"""Z-score anomaly detection over the scored events.

Global statistics are one aggregate row (partial aggregates per task, one
final row) read by every event as scalar subqueries: the row is computed
once and its values act as constants in the projection, so nothing grows
with the data volume but the scan, and the event side is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------
ANOMALY_FEATURES = ["magnitude", "depth_km", "significance"]
ANOMALY_THRESHOLD = 2.5
# Reason tag per feature, in output order.
REASON_TAGS = {
    "magnitude": "unusual_magnitude",
    "depth_km": "unusual_depth",
    "significance": "high_significance",
}
NO_ANOMALY = "none"
# Null fills applied before scoring and training.
SCORE_FILLS = {
    "felt_reports": 0, "cdi": 0, "mmi": 0, "gap_deg": 180,
    "rms": 0, "nst": 0, "significance": 0,
}
SCORED_COLUMNS = ["event_id", "magnitude", "depth_km", "latitude", "longitude",
                  "significance", "felt_reports", "cdi", "mmi", "gap_deg", "rms",
                  "nst", "tsunami_flag", "severity", "region"]
# --------------------------------------------------------------------------------


def scorable(df: DataFrame) -> Column:
    """Events that are scored: magnitude and depth both known."""
    return F.col("magnitude").isNotNull() & F.col("depth_km").isNotNull()


def fill_features(df: DataFrame) -> DataFrame:
    """Null fills of the scoring features; ``tsunami_flag`` as 0/1 int."""
    fills = {c: v for c, v in SCORE_FILLS.items() if c in df.columns}
    cols = {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in fills.items()}
    cols["tsunami_flag"] = F.coalesce(F.col("tsunami_flag"), F.lit(False)).cast("int")
    return df.withColumns(cols)


def scored_base(silver: DataFrame) -> DataFrame:
    """Feature projection of the scorable Silver rows with fills applied."""
    return fill_features(silver.filter(scorable(silver)).select(*SCORED_COLUMNS))


def feature_stats(df: DataFrame, cols: Sequence[str] = ANOMALY_FEATURES) -> DataFrame:
    """One row: mean and population std dev of each column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    return df.agg(*aggs)


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach one-row statistics to every row as scalar subqueries.

    Spark merges the subqueries over the same aggregate into one job, runs it
    once, and the projection reads the values as constants: the event side is
    neither joined nor shuffled, and stays in one whole-stage-codegen span.
    """
    return df.withColumns({c: stats.select(c).scalar() for c in stats.columns})


def zscore_columns(cols: Sequence[str] = ANOMALY_FEATURES,
                   source: dict[str, Column] | None = None) -> dict[str, Column]:
    """``|x - mean| / std`` per column; a missing value takes the mean (z = 0);
    a constant column (std 0) gives null, which is never anomalous.
    ``source`` overrides the expression read for a column."""
    out = {}
    source = source or {}
    for c in cols:
        mu, sd = F.col(f"_mu_{c}"), F.col(f"_sd_{c}")
        x = F.coalesce(source.get(c, F.col(c)).cast("double"), mu)
        out[f"zscore_{c}"] = F.abs(F.try_divide(x - mu, sd))
    return out


def zscore(df: DataFrame, cols: Sequence[str] = ANOMALY_FEATURES,
           stats: DataFrame | None = None) -> DataFrame:
    """Add ``zscore_<col>`` for each column, statistics over all of ``df``."""
    stats = feature_stats(df, cols) if stats is None else stats
    out = with_stats(df, stats).withColumns(zscore_columns(cols))
    return out.drop(*[c for c in out.columns if c.startswith(("_mu_", "_sd_"))])


def anomaly_columns(cols: Sequence[str] = ANOMALY_FEATURES,
                    k: float = ANOMALY_THRESHOLD) -> dict[str, Column]:
    """``is_anomaly`` (any z > k), ``anomaly_reason``, ``anomaly_score``."""
    over = {c: F.coalesce(F.col(f"zscore_{c}") > F.lit(k), F.lit(False)) for c in cols}
    any_over = None
    for c in cols:
        any_over = over[c] if any_over is None else (any_over | over[c])
    flag = any_over.cast("int")
    reason = F.concat_ws(" ", *[F.when(over[c], F.lit(REASON_TAGS.get(c, f"unusual_{c}"))) for c in cols])
    score = F.greatest(*[F.nanvl(F.col(f"zscore_{c}"), F.lit(None).cast("double")) for c in cols])
    return {
        "is_anomaly": flag,
        "anomaly_reason": F.when(flag == 0, F.lit(NO_ANOMALY)).otherwise(reason),
        "anomaly_score": F.bround(score, 4),
    }


def anomalies(df: DataFrame, cols: Sequence[str] = ANOMALY_FEATURES,
              k: float = ANOMALY_THRESHOLD) -> DataFrame:
    """Z-scores plus anomaly flag, reason and score."""
    return zscore(df, cols).withColumns(anomaly_columns(cols, k))


def anomaly_summary(ml: DataFrame) -> DataFrame:
    """Rollup by (is_anomaly, anomaly_reason); unscored events form the null group."""
    return (ml.groupBy("is_anomaly", "anomaly_reason")
              .agg(F.count(F.lit(1)).alias("event_count"),
                   F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
                   F.max("magnitude").alias("max_magnitude"),
                   F.round(F.avg("depth_km"), 2).alias("avg_depth_km"))
              .orderBy(F.col("is_anomaly").desc(), "anomaly_reason"))
