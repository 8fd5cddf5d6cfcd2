"""Layer job: Bronze -> Silver -> Gold -> ML -> reports -> export, each layer
written once and read back by the next (storage is the barrier between
layers, so no layer's plan is recomputed downstream).

Silver and Gold are partitioned by ``event_date`` for pruning (time-window
reports, per-date refresh).  Writes use the ``rebalance`` hint: adaptive
execution sizes output partitions and splits a hot date over several tasks,
so a date holding a third of all events is not written by one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly as an
from ..operators import classifier as clf
from ..operators import reports as rp
from ..operators.dedup import BRONZE_ORDER
from ..operators.gold import gold
from ..operators.silver import silver
from ..session import fresh_path, prepare
from ..sources import export as ex


@dataclass
class LayerRun:
    root: str
    paths: dict[str, str] = field(default_factory=dict)
    manifest: list[dict] = field(default_factory=list)


def _write_by_date(df: DataFrame, path: str, date_expr) -> None:
    (df.withColumn("event_date", date_expr)
       .hint("rebalance", "event_date")
       .write.mode("overwrite").partitionBy("event_date").parquet(path))


def build_layers(spark: SparkSession, bronze: DataFrame, root: str | None = None,
                 order=BRONZE_ORDER, estimator=None, export_root: str | None = None) -> LayerRun:
    prepare(spark)
    run = LayerRun(root or fresh_path(spark, "layers"))
    p = run.paths

    p["silver"] = f"{run.root}/silver"
    _write_by_date(silver(bronze, order=order), p["silver"], F.to_date("event_timestamp"))
    s = spark.read.parquet(p["silver"]).drop("event_date")

    p["gold"] = f"{run.root}/gold"
    _write_by_date(gold(s), p["gold"], F.to_date("event_hour"))

    feats = clf.split_flag(an.scored_base(s))
    model = clf.train(feats.filter("is_train"), estimator)
    p["model"] = f"{run.root}/model"
    clf.save_model(model, p["model"])
    p["ml"] = f"{run.root}/ml_predictions"
    clf.ml_table(s, model=model).write.mode("overwrite").parquet(p["ml"])
    ml = spark.read.parquet(p["ml"])

    p["ml_runs"] = f"{run.root}/ml_runs"
    test_pred = clf.predict(model, feats.filter("is_test"))
    clf.run_record(model, feats.filter("is_train"), test_pred).write.mode("append").parquet(p["ml_runs"])

    p["reports"] = f"{run.root}/genai_outputs"
    rp.append_history(rp.render_reports(ml), p["reports"])
    # The complete event lists behind the reports, one row per line.
    p["report_lines"] = f"{run.root}/report_context_lines"
    rp.context_lines(ml).write.mode("overwrite").parquet(p["report_lines"])

    exp = export_root or f"{run.root}/export"
    p["export"] = exp
    g = spark.read.parquet(p["gold"]).drop("event_date")
    for name, df in (("gold_insights", g), ("ml_predictions", ml),
                     ("genai_outputs", spark.read.parquet(p["reports"]))):
        run.manifest.append(ex.export(df, exp, name))
    return run


def main(argv: list[str] | None = None) -> None:
    """``python -m seismiq.plans.medallion --bronze PATH [--landing] [--root OUT] [--cores N]``

    Runs the layer job over a Bronze Parquet table, or over a landing folder
    of NDJSON batches (``--landing``: the files are read as Bronze rows with a
    load time of the run), and prints the export manifest as JSON lines.
    """
    import argparse
    import json

    from ..sources.landing import read_landing
    from ..session import apply_scale, build_session

    ap = argparse.ArgumentParser(prog="seismiq.plans.medallion")
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--landing", action="store_true")
    ap.add_argument("--root", default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--cores", type=int, default=None,
                    help="cluster cores: size scan splits and shuffle partitions for the input")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    if args.cores:
        print(json.dumps({"scale_settings": apply_scale(spark, args.bronze, args.cores)}))
    if args.landing:
        bronze = read_landing(spark, args.bronze).withColumns({
            "bronze_load_timestamp": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path")})
    else:
        bronze = spark.read.parquet(args.bronze)
    run = build_layers(spark, bronze, args.root)
    for m in run.manifest:
        print(json.dumps(m))
    print(json.dumps(run.paths))


if __name__ == "__main__":
    main()
