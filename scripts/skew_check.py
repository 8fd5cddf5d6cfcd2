"""Hot-key experiment: does any task receive a hot third of the rows?

Usage: python scripts/skew_check.py [sf_dir] [copies]

Builds ``copies`` x the sf observations with distinct ids (Silver rows), then
runs, on a uniform variant and on a variant where one group holds a third
of the rows:
  * Gold (E2) with one (hour, severity, region) group holding a third;
  * the complete report lines (``context_lines``), with one magnitude
    holding a third of the events.
Task-level records come from Spark's event log, written to a fresh scratch
folder.  Prints each run's wall time, then the largest number of shuffle
records one task of the run read, against the run's total.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str) -> list[dict]:
    out = []
    for f in glob.glob(f"{log_dir}/*"):
        paths = glob.glob(f"{f}/events_*") if os.path.isdir(f) else [f]
        for p in paths:
            raw = open(p, "rb")
            if p.endswith(".zstd"):
                import zstandard
                raw = zstandard.ZstdDecompressor().stream_reader(raw)
            out += [json.loads(x) for x in io.TextIOWrapper(raw, encoding="utf-8")]
    return out


def _max_task_shuffle_records(log_dir: str, tag: str) -> tuple[int, int]:
    """(largest, total) shuffle records read by one task of the tagged jobs."""
    ev = _events(log_dir)
    stages = {s["Stage ID"] for e in ev if e["Event"] == "SparkListenerJobStart"
              and e.get("Properties", {}).get("spark.job.description") == tag
              for s in e["Stage Infos"]}
    per_task = [e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                for e in ev if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages
                and e.get("Task Metrics")]
    return (max(per_task) if per_task else 0, sum(per_task))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    log_dir = tempfile.mkdtemp(prefix="seismiq-eventlog-", dir="/tmp")
    from pyspark.sql import functions as F

    from seismiq.operators.classifier import ml_table
    from seismiq.operators.gold import gold
    from seismiq.operators.reports import context_lines
    from seismiq.operators.silver import silver
    from seismiq.session import build_session, fresh_path
    from seismiq.sources.adapter import OBS_ORDER, load_events, observations

    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.ui.showConsoleProgress": "false"})
    ev = load_events(spark, sf_dir)
    n = ev.count()
    big = (ev.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
             .withColumn("event_id", F.col("event_id") + F.col("_copy") * n).drop("_copy"))
    base = fresh_path(spark, "skew_silver")
    silver(observations(big), order=OBS_ORDER, stamp=False).write.parquet(base)
    s = spark.read.parquet(base)
    rows = s.count()
    hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    variants = {
        "uniform": s,
        "hot group": s.withColumns({
            "event_timestamp": F.when(hot, F.lit("2024-01-15 12:30:00").cast("timestamp_ntz"))
                                .otherwise(F.col("event_timestamp")),
            "severity": F.when(hot, F.lit("MINOR")).otherwise(F.col("severity")),
            "region": F.when(hot, F.lit("Asia")).otherwise(F.col("region")),
            "magnitude": F.when(hot, F.lit(3.5)).otherwise(F.col("magnitude"))}),
    }
    print(f"silver rows: {rows}")
    for name, df in variants.items():
        for op, make in (("gold", lambda d: gold(d, stamp=False)),
                         ("context_lines", lambda d: context_lines(ml_table(d, stamp=False)))):
            tag = f"{op} / {name}"
            spark.sparkContext.setJobDescription(tag)
            t0 = time.perf_counter()
            make(df).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            spark.sparkContext.setJobDescription(None)
            print(f"{tag:28s} {dt:6.2f} s", flush=True)
    spark.stop()
    for name in variants:
        for op in ("gold", "context_lines"):
            tag = f"{op} / {name}"
            mx, tot = _max_task_shuffle_records(log_dir, tag)
            print(f"{tag:28s} largest task read {mx:>9,} of {tot:>10,} shuffled records")


if __name__ == "__main__":
    main()
