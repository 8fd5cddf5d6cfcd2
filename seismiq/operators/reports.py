"""Report datasets (situation summary, clusters, Q&A, playbook) and their
text rendering, all as Spark aggregates.

The text reports replace the hosted language-model calls: each report is the
factual context rendered from bounded aggregates, stored with
``model_used = 'template'``.  Only the final three report rows are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.text import fmt, line, lines_text, or_empty, text_chunks
from ..functions.timefmt import now_utc, ntz_to_iso_text
from ..session import shared_dir
from .gold import flag_count

TEMPLATE_MODEL = "template"


def strongest_first() -> list[Column]:
    return [F.col("magnitude").desc_nulls_last(), F.col("event_id").asc()]


def top_event(ml: DataFrame, cols: list[str]) -> DataFrame:
    """The single strongest event (ties: smallest event id)."""
    return ml.orderBy(*strongest_first()).select(*cols).limit(1)


def daily_kpis(ml: DataFrame) -> DataFrame:
    """One row of headline figures over the ML table.

    A single global aggregate; the strongest event is picked inside it with
    ``min_by`` over a (missing, -magnitude, event_id) key, so no second scan.
    """
    key = F.struct(F.col("magnitude").isNull(), -F.col("magnitude"), F.col("event_id"))
    top = F.min_by(F.struct(F.col("place"), F.col("magnitude")), key)
    return ml.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.max("magnitude").alias("max_magnitude"),
        F.bround(F.avg("magnitude"), 2).alias("avg_magnitude"),
        flag_count(F.col("tsunami_flag") == F.lit(True)).alias("tsunami_count"),
        F.sum("is_anomaly").cast("bigint").alias("anomaly_count"),
        flag_count(labels.is_critical("severity")).alias("critical_events"),
        top.alias("_top"),
    ).select("*", F.col("_top.place").alias("top_event_place"),
             F.col("_top.magnitude").alias("top_event_magnitude")).drop("_top")


def region_profile(ml: DataFrame) -> DataFrame:
    """One row per region: rows, events with an id, mean and max magnitude
    (2 decimals, half-even), anomalies.  The region lists of the reports and
    the region queries all read this one aggregate."""
    return (ml.groupBy("region")
              .agg(F.count(F.lit(1)).alias("events"),
                   F.count("event_id").alias("count"),
                   F.bround(F.avg("magnitude"), 2).alias("avg_mag"),
                   F.bround(F.max("magnitude"), 2).alias("max_mag"),
                   F.sum("is_anomaly").cast("bigint").alias("anomalies")))


def top_regions(ml: DataFrame, n: int = 3) -> DataFrame:
    """Most active regions by event count (ties: region name)."""
    return (ml.groupBy("region").agg(F.count(F.lit(1)).alias("events"))
              .orderBy(F.col("events").desc(), F.col("region")).limit(n))


def most_active_region(ml: DataFrame) -> DataFrame:
    return top_regions(ml, 1)


def cluster_summary(ml: DataFrame) -> DataFrame:
    """Per region: events, mean and max magnitude (2 decimals, half-even),
    anomalies."""
    return region_profile(ml).drop("events").orderBy("region")


def critical_events(ml: DataFrame, hours: int = 24) -> DataFrame:
    """Critical events (MAJOR/STRONG/CATASTROPHIC) within ``hours`` of the
    latest event time, strongest first.  The anchor is the data's own latest
    time (a scalar subquery, computed once), so the result is reproducible."""
    latest = ml.agg(F.max("event_timestamp")).scalar()
    since = latest - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (ml.filter(labels.is_critical("severity"))
              .filter(F.col("event_timestamp") >= since)
              .select("event_id", "place", "magnitude", "severity", "depth_km", "region",
                      "event_timestamp", "anomaly_reason")
              .orderBy(*strongest_first()))


def anomalous_events(ml: DataFrame) -> DataFrame:
    return (ml.filter(F.col("is_anomaly") == 1)
              .select("event_id", "place", "magnitude", "anomaly_reason")
              .orderBy(*strongest_first()))


# fixed values: columns the report step reads
PLAYBOOK_FIELDS = ["event_id", "place", "magnitude", "severity", "depth_km", "tsunami_flag",
                   "region", "anomaly_reason"]


def playbook_event(ml: DataFrame, with_prediction: bool = False) -> DataFrame:
    """The strongest event with the fields an emergency playbook needs."""
    cols = list(PLAYBOOK_FIELDS)
    out = top_event(ml, cols + (["predicted_severity", "prediction_confidence"] if with_prediction else []))
    if with_prediction:
        out = out.withColumn("confidence_pct", F.bround(F.col("prediction_confidence") * 100, 1)) \
                 .drop("prediction_confidence")
    return out


# fixed values: columns the report step reads
QA_COLUMNS = ["place", "magnitude", "severity", "depth_km", "region", "tsunami_flag",
              "is_anomaly", "event_time_utc", "predicted_severity", "prediction_confidence"]


def qa_context(ml: DataFrame) -> DataFrame:
    """Event-level columns a question-answering step reads, strongest first."""
    if "event_time_utc" not in ml.columns and "event_timestamp" in ml.columns:
        ml = ml.withColumn("event_time_utc", ntz_to_iso_text("event_timestamp"))
    cols = [c for c in QA_COLUMNS if c in ml.columns]
    return ml.orderBy(*strongest_first()).select(*cols)


def context_lines(ml: DataFrame) -> DataFrame:
    """The whole-table lists of the report contexts, complete: a row for each
    anomalous event (daily summary) and for each event (cluster explanation).

    ``(output_type, section, region, magnitude, event_id, line)``: a reader
    sorts a section by what it needs (strongest first, or region first).  The
    lists stay distributed rows; the report rows hold the headline figures.
    """
    anomalies = ml.filter(F.col("is_anomaly") == 1).select(
        F.lit("daily_summary").alias("output_type"), F.lit("anomalous_events").alias("section"),
        "region", "magnitude", "event_id", line("place", "magnitude", "anomaly_reason").alias("line"))
    events = ml.select(
        F.lit("cluster_explanation").alias("output_type"), F.lit("events").alias("section"),
        "region", "magnitude", "event_id",
        line("place", "magnitude", "depth_km", "region", "anomaly_reason").alias("line"))
    return anomalies.unionByName(events)


def context_chunks(ml: DataFrame, chunk_chars: int = 1 << 20) -> DataFrame:
    """The complete text of each list of ``context_lines``, strongest event first, as numbered chunks.

    ``(output_type, section, chunk, lines, content)``: a section's chunks joined
    by line breaks are its whole text.
    """
    return text_chunks(context_lines(ml), F.col("line"), strongest_first(), ["output_type", "section"], chunk_chars)


# ---- text rendering ---------------------------------------------------------------

# The situation summary lists this many strongest events.
TOP_EVENTS = 5


def _daily_summary(ml: DataFrame, regions: DataFrame, tops: DataFrame) -> DataFrame:
    k = daily_kpis(ml)
    region_txt = or_empty(lines_text(
        regions, F.concat(F.col("region"), F.lit(": "), F.col("events").cast("string")),
        [F.col("events").desc(), F.col("region")], 3))
    top_txt = or_empty(lines_text(tops, line("place", "magnitude", "severity", "region", "depth_km"),
                                  strongest_first(), TOP_EVENTS))
    k = k.withColumns({"regions": region_txt, "top5": top_txt})
    return k.select(
        F.lit("daily_summary").alias("output_type"),
        F.concat_ws("\n",
                    F.lit("SEISMIC SITUATION SUMMARY"),
                    F.concat(F.lit("Events: "), fmt("total_events")),
                    F.concat(F.lit("Largest magnitude: "), fmt("max_magnitude")),
                    F.concat(F.lit("Mean magnitude: "), fmt("avg_magnitude")),
                    F.concat(F.lit("Tsunami flags: "), fmt("tsunami_count")),
                    F.concat(F.lit("Anomalies: "), fmt("anomaly_count")),
                    F.concat(F.lit("Most active regions: "), F.regexp_replace("regions", "\n", ", ")),
                    F.concat(F.lit("Strongest event: M"), fmt("top_event_magnitude"), F.lit(" at "),
                             fmt("top_event_place")),
                    F.concat(F.lit("Critical events: "), fmt("critical_events")),
                    F.lit(""), F.lit("Five strongest events:"), F.col("top5")).alias("content"))


def _cluster_explanation(spark, regions: DataFrame) -> DataFrame:
    # every region: each label, plus a group for a missing region
    clusters = or_empty(lines_text(regions, line("region", "count", "avg_mag", "max_mag", "anomalies"),
                                   [F.col("region")], len(labels.REGION_LABELS) + 1))
    return spark.range(1).select(
        F.lit("cluster_explanation").alias("output_type"),
        F.concat_ws("\n", F.lit("ACTIVITY BY REGION (region | events | mean | max | anomalies)"),
                    clusters).alias("content"))


def _playbook(ml: DataFrame, tops: DataFrame) -> DataFrame:
    has_pred = "predicted_severity" in ml.columns
    ev = playbook_event(tops, with_prediction=has_pred)
    parts = [F.lit("RESPONSE PLAYBOOK INPUT"),
             F.concat(F.lit("Location: "), fmt("place")),
             F.concat(F.lit("Magnitude: M"), fmt("magnitude")),
             F.concat(F.lit("Severity: "), fmt("severity")),
             F.concat(F.lit("Depth: "), fmt("depth_km"), F.lit(" km")),
             F.concat(F.lit("Tsunami flag: "), fmt("tsunami_flag")),
             F.concat(F.lit("Region: "), fmt("region")),
             F.concat(F.lit("Anomaly: "), fmt("anomaly_reason"))]
    if has_pred:
        parts.append(F.concat(F.lit("Model prediction: "), fmt("predicted_severity"),
                              F.lit(" (confidence "), fmt("confidence_pct"), F.lit("%)")))
    return ev.select(F.lit("response_playbook").alias("output_type"),
                     F.concat_ws("\n", *parts).alias("content"))


def render_reports(ml: DataFrame) -> DataFrame:
    """Three report rows: (output_type, content, generated_at, model_used).

    The rows hold the headline figures, the three most active regions, the
    five strongest events, the region table and the strongest event's
    playbook; the complete event lists are ``context_lines``.  Everything is
    read from three passes over ``ml``: the headline aggregate, one
    per-region aggregate and the strongest events.  Each text block is a
    scalar subquery over a few rows.
    """
    # Both sets are small (one row per region; a few events) and each feeds
    # several blocks: checkpointed once (to the shared folder), they cost one
    # pass over ``ml`` each instead of one per block.
    shared_dir(ml.sparkSession)
    regions = region_profile(ml).checkpoint()
    tops = ml.orderBy(*strongest_first()).limit(TOP_EVENTS).checkpoint()
    parts = [_daily_summary(ml, regions, tops),
             _cluster_explanation(ml.sparkSession, regions),
             _playbook(ml, tops)]
    out = reduce(DataFrame.unionByName, parts)
    return out.select("output_type", "content",
                      F.date_format(now_utc(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
                      F.lit(TEMPLATE_MODEL).alias("model_used"))


def append_history(reports: DataFrame, path: str) -> None:
    """Append report rows to the history table at ``path``."""
    reports.write.mode("append").parquet(path)


def report_history(history: DataFrame) -> DataFrame:
    """Newest first, with a 200-character preview of each report."""
    return (history.select("output_type", "generated_at",
                           F.left(F.col("content"), F.lit(200)).alias("content_preview"))
                   .orderBy(F.col("generated_at").desc(), "output_type"))


# fixed values: columns the report step reads
GOLD_CONTEXT_COLUMNS = ["event_hour", "severity", "region", "total_events", "avg_magnitude",
                        "max_magnitude", "tsunami_count", "most_notable_place"]


def gold_context(gold: DataFrame) -> DataFrame:
    """Gold rows a question-answering step reads, strongest first."""
    return (gold.select(*GOLD_CONTEXT_COLUMNS)
                .orderBy(F.col("max_magnitude").desc_nulls_last(), F.col("event_hour").desc(),
                         "severity", "region"))
