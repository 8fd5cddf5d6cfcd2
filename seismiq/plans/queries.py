"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They compose the library operators over the driver's tables.  Run-time
stamps (load times, run ids, file paths) are left out of oracle-checked
results because they are the wall clock of the run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly as an
from ..operators import audit, dashboards, profiles, topk
from ..operators import classifier as clf
from ..operators import reports as rp
from ..operators.dedup import dedup_latest
from ..operators.gold import gold
from ..operators.silver import silver
from ..session import fresh_path, prepare
from ..sources import catalog
from ..sources import export as ex
from ..sources import geojson as gj
from ..sources import landing as ld
from ..sources import versions as vs
from ..sources.adapter import OBS_ORDER, feed_records, load_events, load_observations, observations
from ..sources.schemas import FEATURE_COLUMNS, FEED_COLUMNS
from ..streaming import bronze as sb
from ..streaming import evolving as ev
from ..streaming import silver as ss

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---- shared building blocks --------------------------------------------------

def bronze_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return load_observations(spark, sf_dir)


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze_of(spark, sf_dir), order=OBS_ORDER, stamp=False)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once as Parquet to the shared folder and read back.

    For queries that pass over Silver twice (global statistics then rows,
    row count then rows, several report blocks): scanning the written table
    is cheaper than running the dedup shuffle again, keeps column pruning
    and filter pushdown, and cuts the lineage so a lost executor does not
    recompute the dedup.
    """
    path = fresh_path(spark, "silver")
    silver_of(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def gold_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(silver_of(spark, sf_dir), stamp=False)


# ---- step 1-3: layers, profiles, top-k, audit, dashboards ------------------------

@register("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    return dedup_latest(bronze_of(spark, sf_dir), "event_id", OBS_ORDER).select(
        "event_id", "obs_seq", "event_timestamp")


@register("silver_enriched")
def q_silver_enriched(spark, sf_dir):
    return silver_of(spark, sf_dir)


@register("gold_insights")
def q_gold_insights(spark, sf_dir):
    return gold_of(spark, sf_dir)


@register("bronze_profile")
def q_bronze_profile(spark, sf_dir):
    return profiles.profile(bronze_of(spark, sf_dir))


@register("silver_validation")
def q_silver_validation(spark, sf_dir):
    return profiles.silver_validation(silver_of(spark, sf_dir))


@register("top_events")
def q_top_events(spark, sf_dir):
    return topk.top_events(silver_of(spark, sf_dir), 11)


@register("top_insights")
def q_top_insights(spark, sf_dir):
    return topk.top_insights(gold_of(spark, sf_dir), 9)


@register("layer_audit")
def q_layer_audit(spark, sf_dir):
    s = silver_table(spark, sf_dir)
    return audit.layer_audit({"BRONZE": bronze_of(spark, sf_dir), "SILVER": s,
                              "GOLD": gold(s, stamp=False)})


@register("dash_severity")
def q_dash_severity(spark, sf_dir):
    return dashboards.events_by_severity(gold_of(spark, sf_dir))


@register("dash_region_max")
def q_dash_region_max(spark, sf_dir):
    return dashboards.max_magnitude_by_region(gold_of(spark, sf_dir))


@register("dash_hourly")
def q_dash_hourly(spark, sf_dir):
    return dashboards.hourly_activity(gold_of(spark, sf_dir))


@register("dash_top_events")
def q_dash_top_events(spark, sf_dir):
    return dashboards.top_event_table(silver_of(spark, sf_dir), 10)


# ---- step 4-6: anomaly, ML features, classifier ---------------------------------


def trained_model(spark: SparkSession, sf_dir: str, s: DataFrame | None = None):
    """The classifier of a run, fitted on its training split."""
    s = silver_table(spark, sf_dir) if s is None else s
    return clf.train(clf.split_flag(an.scored_base(s)).filter("is_train"))


def ml_of(spark: SparkSession, sf_dir: str, with_model: bool = False,
          s: DataFrame | None = None) -> DataFrame:
    s = silver_table(spark, sf_dir) if s is None else s
    model = trained_model(spark, sf_dir, s) if with_model else None
    return clf.ml_table(s, model=model, stamp=False)


@register("zscore")
def q_zscore(spark, sf_dir):
    z = an.zscore(an.scored_base(silver_table(spark, sf_dir)))
    return z.select("event_id", "magnitude", "depth_km", "significance",
                    *[F.round(f"zscore_{c}", 4).alias(f"zscore_{c}") for c in an.ANOMALY_FEATURES])


@register("anomaly_flags")
def q_anomaly_flags(spark, sf_dir):
    return an.anomalies(an.scored_base(silver_table(spark, sf_dir))).select(
        "event_id", "is_anomaly", "anomaly_reason", "anomaly_score")


@register("anomaly_summary")
def q_anomaly_summary(spark, sf_dir):
    return an.anomaly_summary(ml_of(spark, sf_dir))


@register("dash_anomaly")
def q_dash_anomaly(spark, sf_dir):
    return dashboards.anomaly_counts(ml_of(spark, sf_dir))


@register("ml_features")
def q_ml_features(spark, sf_dir):
    return clf.split_flag(an.scored_base(silver_table(spark, sf_dir)))


@register("ml_enriched")
def q_ml_enriched(spark, sf_dir):
    ml = ml_of(spark, sf_dir, with_model=True)
    return ml.select("event_id", "severity", "region", "is_anomaly", "anomaly_reason",
                     "anomaly_score", F.col("predicted_severity").isNotNull().alias("scored"))


@register("ml_report")
def q_ml_report(spark, sf_dir):
    s = silver_table(spark, sf_dir)
    model = trained_model(spark, sf_dir, s)
    feats = clf.split_flag(an.scored_base(s))
    pred = clf.predict(model, feats.filter("is_test"))
    return clf.classification_report(pred, clf.class_labels(model))


@register("ml_importance")
def q_ml_importance(spark, sf_dir):
    return clf.importance(trained_model(spark, sf_dir))


@register("ml_review")
def q_ml_review(spark, sf_dir):
    return topk.ml_review(ml_of(spark, sf_dir, with_model=True), 20)


@register("dash_predicted")
def q_dash_predicted(spark, sf_dir):
    return dashboards.predicted_counts(ml_of(spark, sf_dir, with_model=True))


# ---- step 7: report datasets ----------------------------------------------------


@register("daily_kpis")
def q_daily_kpis(spark, sf_dir):
    return rp.daily_kpis(ml_of(spark, sf_dir))


@register("top_regions")
def q_top_regions(spark, sf_dir):
    return rp.top_regions(silver_of(spark, sf_dir), 3)


@register("most_active_region")
def q_most_active_region(spark, sf_dir):
    return rp.most_active_region(silver_of(spark, sf_dir))


@register("cluster_summary")
def q_cluster_summary(spark, sf_dir):
    return rp.cluster_summary(ml_of(spark, sf_dir))


@register("critical_24h")
def q_critical_24h(spark, sf_dir):
    return rp.critical_events(ml_of(spark, sf_dir), 24)


@register("anomalous_events")
def q_anomalous_events(spark, sf_dir):
    return rp.anomalous_events(ml_of(spark, sf_dir))


@register("playbook_event")
def q_playbook_event(spark, sf_dir):
    return rp.playbook_event(ml_of(spark, sf_dir))


@register("report_lines")
def q_report_lines(spark, sf_dir):
    return rp.context_lines(ml_of(spark, sf_dir))


@register("qa_context")
def q_qa_context(spark, sf_dir):
    return rp.qa_context(written_ml(spark, sf_dir))


def written_ml(spark, sf_dir, with_model: bool = True, s: DataFrame | None = None) -> DataFrame:
    """The ML table as the layer job leaves it: written once, then read.
    Report renderers scan it several times; scanning the written table avoids
    re-running dedup and forest scoring per scan."""
    path = fresh_path(spark, "ml_predictions")
    s = silver_table(spark, sf_dir) if s is None else s
    model = trained_model(spark, sf_dir, s) if with_model else None
    clf.ml_table(s, model=model).write.parquet(path)
    return spark.read.parquet(path)


def _history(spark, sf_dir) -> str:
    """Render the three reports and append them to a fresh history table."""
    path = fresh_path(spark, "report_history")
    rp.append_history(rp.render_reports(written_ml(spark, sf_dir)), path)
    return path


@register("report_text")
def q_report_text(spark, sf_dir):
    """The three reports rendered from the ML table's anomaly scores, without
    a classifier (prediction fields read None): every character is
    deterministic, so the rendering itself is oracle-checked."""
    return rp.render_reports(written_ml(spark, sf_dir, with_model=False)).select(
        "output_type", "content")


@register("report_history")
def q_report_history(spark, sf_dir):
    return rp.report_history(spark.read.parquet(_history(spark, sf_dir)))


@register("dash_reports")
def q_dash_reports(spark, sf_dir):
    return dashboards.report_table(spark.read.parquet(_history(spark, sf_dir)))


# ---- step 8: JSON sources and streaming -------------------------------------------


# Features per GeoJSON document: documents are keyed by ranges of the row
# sequence, so a document never exceeds this many features.
FEATURES_PER_DOC = 500
# Landing batches are weekly slices of the feed.
LANDING_BATCH_DAYS = 7


def _feed(spark, sf_dir, keep=()):
    return feed_records(bronze_of(spark, sf_dir), keep=keep)


@register("geojson_flatten")
def q_geojson_flatten(spark, sf_dir):
    path = fresh_path(spark, "geojson")
    feed = _feed(spark, sf_dir, keep=("obs_seq",))
    gj.write_geojson(feed, path, F.floor(F.col("obs_seq") / FEATURES_PER_DOC))
    flat = gj.read_geojson(spark, path, multiline=False)
    return flat.drop("ingestion_timestamp_utc")


@register("geojson_multiline")
def q_geojson_multiline(spark, sf_dir):
    """Published form: an indented document a file."""
    path = fresh_path(spark, "geojson")
    feed = _feed(spark, sf_dir, keep=("obs_seq",))
    gj.write_geojson(feed, path, F.floor(F.col("obs_seq") / FEATURES_PER_DOC), pretty=True)
    return gj.read_geojson(spark, f"{path}/*/*.txt").drop("ingestion_timestamp_utc")


def land_feed(spark, sf_dir) -> str:
    """Land the feed as NDJSON batches by week, in one job."""
    landing = fresh_path(spark, "landing")
    feed = _feed(spark, sf_dir, keep=("event_timestamp",))
    day = F.datediff(F.col("event_timestamp").cast("date"), F.lit("2000-01-01").cast("date"))
    return ld.land_by(feed.withColumn("batch", F.floor(day / LANDING_BATCH_DAYS)).drop("event_timestamp"), landing, "batch")


@register("landing_files")
def q_landing_files(spark, sf_dir):
    landing = land_feed(spark, sf_dir)
    files = ld.list_landing(spark, landing)
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.sum("size_bytes").alias("bytes"))


@register("landing_read")
def q_landing_read(spark, sf_dir):
    return ld.read_landing(spark, land_feed(spark, sf_dir))


# The registered streams take the feed in this many polls, whatever its size.
POLLS = 6
# rows of a landed file: about 3 MB at least (but for small polls), 110 MB at most
MIN_LANDED, MAX_LANDED = 5_000, 200_000


def files_per_poll(rows: int, cores: int) -> int:
    """Files that a poll of so many rows lands as: one for each core, or so many times more."""
    return max(1, min(cores * -(-rows // (cores * MAX_LANDED)), -(-rows // MIN_LANDED)))


def polls(spark, sf_dir) -> list[DataFrame]:
    """The observations in ranges of the row sequence, as a fetcher polls them one after the other.

    A range lies in a few splits of the table, so its rows are dealt to all cores
    before they are mapped.  Every poll has as many partitions, hence files: a
    micro-batch of the streams is then a poll, and does not share events with the next.
    """
    events = load_events(spark, sf_dir)
    last, rows = events.agg(F.max("event_id"), F.count("event_id")).first()
    size, files = (last or 0) + 1, files_per_poll(-(-rows // POLLS), spark.sparkContext.defaultParallelism)
    bounds = [-(-size * i // POLLS) for i in range(POLLS + 1)]
    return [observations(events.where((F.col("event_id") >= low) & (F.col("event_id") < high)).repartition(files))
            for low, high in zip(bounds, bounds[1:])]


def without_times(feed: DataFrame) -> DataFrame:
    """Some events lose their time, some get one that does not parse."""
    return feed.withColumn("event_time_utc", F.when(F.col("obs_seq") % 61 == 0, F.lit(None)).when(F.col("obs_seq") % 67 == 0, F.lit("12:30"))
                           .otherwise(F.col("event_time_utc")))


def land_polls(spark, sf_dir, change=None) -> str:
    """Land the polls one after the other; ``change(i, feed)`` alters a poll's records (``obs_seq`` is dropped after it)."""
    prepare(spark)
    landing = fresh_path(spark, "landing")
    for i, obs in enumerate(polls(spark, sf_dir)):
        feed = feed_records(obs, keep=("obs_seq",))
        feed = change(i, feed) if change else feed
        ld.land(feed.drop("obs_seq"), landing, f"batch={i:02d}")
    return landing


def _run_bronze(spark, sf_dir, untimed: bool = False, progress: str | None = None) -> str:
    """Bronze from the landed polls, in as many micro-batches as there are polls."""
    landing = land_polls(spark, sf_dir, (lambda i, feed: without_times(feed)) if untimed else None)
    bronze = fresh_path(spark, "bronze")
    files = sb.files_per_batch(ld.list_landing(spark, landing).count(), POLLS)
    q = sb.start_bronze(spark, landing, bronze, fresh_path(spark, "ckpt_bronze"), max_files=files)
    q.awaitTermination()
    if progress:
        sb.append_progress(spark, q, progress, "bronze")
    return bronze


def _run_silver(spark, bronze: str, with_gold: bool = False, progress: str | None = None) -> str:
    """Versions of Silver (and Gold) from the Bronze table, in several micro-batches."""
    root = fresh_path(spark, "layers_stream")
    files = sb.files_per_batch(len(spark.read.parquet(bronze).inputFiles()), POLLS)
    q = ss.start_silver(spark, bronze, root, fresh_path(spark, "ckpt_silver"), max_files=files, with_gold=with_gold)
    q.awaitTermination()
    if progress:
        sb.append_progress(spark, q, progress, "silver")
    return root


@register("bronze_stream")
def q_bronze_stream(spark, sf_dir):
    bronze = _run_bronze(spark, sf_dir)
    return spark.read.parquet(bronze).select(*FEED_COLUMNS)


@register("silver_stream")
def q_silver_stream(spark, sf_dir):
    return ss.read_silver(spark, _run_silver(spark, _run_bronze(spark, sf_dir)), stamp=False)


# ---- step 9: export and table status ----------------------------------------------


@register("export_gold")
def q_export_gold(spark, sf_dir):
    root = fresh_path(spark, "export")
    ex.export(gold_of(spark, sf_dir), root, "gold_insights")
    return spark.read.parquet(ex.target_path(root, "gold_insights"))


@register("export_validation")
def q_export_validation(spark, sf_dir):
    root = fresh_path(spark, "export")
    ex.export(gold_of(spark, sf_dir), root, "gold_insights")
    return ex.export_validation(spark, root, 10)


@register("export_manifest")
def q_export_manifest(spark, sf_dir):
    """Export the three serving tables, then count them back from the target."""
    root = fresh_path(spark, "export")
    s = silver_table(spark, sf_dir)
    ml = written_ml(spark, sf_dir, s=s)
    history = fresh_path(spark, "report_history")
    rp.append_history(rp.render_reports(ml), history)
    ex.export(gold(s, stamp=False), root, "gold_insights")
    ex.export(ml, root, "ml_predictions")
    ex.export(spark.read.parquet(history), root, "genai_outputs")
    return ex.verify_exports(spark, root, ["gold_insights", "ml_predictions", "genai_outputs"])


STATUS_SCHEMA = "seismiq_status"


def _fresh_tables(spark, tables: dict[str, DataFrame], schema: str) -> None:
    """Catalog tables over fresh folders of the shared storage."""
    catalog.ensure_schemas(spark, [schema])
    for name, df in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
        catalog.save_overwrite(df, f"{schema}.{name}", fresh_path(spark, f"tables-{name}"))


@register("table_status")
def q_table_status(spark, sf_dir):
    b, s = bronze_of(spark, sf_dir), silver_table(spark, sf_dir)
    _fresh_tables(spark, {"bronze": b, "silver": s, "gold": gold(s, stamp=False), "ml": clf.ml_table(s, stamp=False)}, STATUS_SCHEMA)
    names = ["bronze", "silver", "gold", "ml", "reports"]
    return audit.table_status(spark, [f"{STATUS_SCHEMA}.{n}" for n in names])


@register("catalog_tables")
def q_catalog_tables(spark, sf_dir):
    """Create a schema, overwrite a table with another schema, append to one, list them, count them."""
    schema = "seismiq_catalog"
    g = gold_of(spark, sf_dir)
    _fresh_tables(spark, {"replaced": g, "appended": g.select("severity")}, schema)
    path = fresh_path(spark, "tables-replaced-again")
    catalog.save_overwrite(g.select("region", "total_events"), f"{schema}.replaced", path)
    catalog.save_append(g.select("severity"), f"{schema}.appended")
    names = sorted(r["tableName"] for r in catalog.list_tables(spark, schema).collect())
    return reduce(DataFrame.unionByName, [
        spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("table_name"), F.lit(",".join(spark.table(f"{schema}.{n}").columns)).alias("columns"), "rows")
        for n in names])


@register("gold_stream")
def q_gold_stream(spark, sf_dir):
    """Bronze stream -> streaming Silver -> Gold kept current by retraction, batch by batch."""
    return ss.read_gold(spark, _run_silver(spark, _run_bronze(spark, sf_dir), with_gold=True))


@register("gold_stream_untimed")
def q_gold_stream_untimed(spark, sf_dir):
    """The same over a feed some of whose events have no time, or one that does not parse."""
    return ss.read_gold(spark, _run_silver(spark, _run_bronze(spark, sf_dir, untimed=True), with_gold=True))


@register("stream_batches")
def q_stream_batches(spark, sf_dir):
    """That the streams ran in several batches, and how much of Silver Gold read again."""
    root = _run_silver(spark, _run_bronze(spark, sf_dir), with_gold=True)
    return ss.read_batches(spark, root).agg(
        (F.count(F.lit(1)) >= POLLS - 1).alias("several"), (F.max("batch_id") > 0).alias("later_batches"),
        (F.sum("stale_groups") <= F.sum("groups")).alias("stale_within_moved"), F.lit(vs.latest(spark, root) > 0).alias("published_later"))


@register("stream_progress")
def q_stream_progress(spark, sf_dir):
    """Progress of the Bronze and Silver streams as a table, added up by stream."""
    path = fresh_path(spark, "progress")
    _run_silver(spark, _run_bronze(spark, sf_dir, progress=path), progress=path)
    rows = sb.read_progress(spark, path)
    return rows.groupBy("query").agg(F.sum("input_rows").alias("input_rows"), F.max("state_rows").alias("state_rows"),
                                     (F.max("batch_id") > 0).alias("later_batches"))


@register("stream_recovered")
def q_stream_recovered(spark, sf_dir):
    """A batch fails between staging and publication; readers then see the version before it; the restart publishes it.

    Gold after the restart, with what a reader saw in between: whether a version
    older than the failed batch, and as many events in Silver as in its Gold.
    """
    bronze, root, ckpt = _run_bronze(spark, sf_dir), fresh_path(spark, "layers_stream"), fresh_path(spark, "ckpt_silver")
    files = sb.files_per_batch(len(spark.read.parquet(bronze).inputFiles()), POLLS)
    fails_at, seen = POLLS // 2, {}

    def fail(batch_id: int) -> None:
        if batch_id == fails_at:
            raise RuntimeError("lost between staging and publication")

    q = ss.start_silver(spark, bronze, root, ckpt, max_files=files, with_gold=True, before_publish=fail)
    try:
        q.awaitTermination()
    except StreamingQueryException:
        seen["version"] = vs.latest(spark, root)
        seen["silver"] = ss.read_silver(spark, root, stamp=False).count()
        seen["gold"] = ss.read_gold(spark, root).agg(F.sum("total_events")).first()[0]
    ss.start_silver(spark, bronze, root, ckpt, max_files=files, with_gold=True).awaitTermination()
    whole = bool(seen) and seen["version"] == fails_at - 1 and seen["silver"] == seen["gold"]
    return ss.read_gold(spark, root).withColumn("one_version_between", F.lit(whole))


@register("bronze_evolving")
def q_bronze_evolving(spark, sf_dir):
    """Polls with and without two more columns, and one whose significance has fractions, in one append table."""
    def change(i: int, feed: DataFrame) -> DataFrame:
        if i in (2, 3):
            return feed.withColumns({"station_count": F.col("obs_seq") % 12, "review_score": (F.col("obs_seq") % 16) / F.lit(16.0)})
        if i == 4:
            return feed.withColumn("significance", F.col("significance") + F.lit(0.5))
        return feed

    landing, root = land_polls(spark, sf_dir, change), fresh_path(spark, "bronze_evolving")
    files = sb.files_per_batch(ld.list_landing(spark, landing).count(), POLLS)
    ev.start_evolving(spark, landing, root, fresh_path(spark, "ckpt_evolving"), max_files=files).awaitTermination()
    return ev.read_evolving(spark, root).drop("bronze_load_timestamp", "source_file", "batch")


@register("landing_quarantine")
def q_landing_quarantine(spark, sf_dir):
    """Landed lines, some cut off, some no JSON, some with a value of the wrong type: both sides of the split."""
    feed = _feed(spark, sf_dir, keep=("obs_seq",))
    record = F.to_json(F.struct(*FEED_COLUMNS))
    name, kind = F.coalesce("event_id", F.lit("?")), F.col("obs_seq") % 37
    lines = feed.select(F.when(kind == 5, F.concat(F.lit('{"event_id":"'), name, F.lit('","magnitude":')))
                        .when(kind == 6, F.concat(F.lit("no record "), F.col("obs_seq")))
                        .when(kind == 7, F.concat(F.lit('{"event_id":"'), name, F.lit('","magnitude":"strong"}'))).otherwise(record).alias("value"))
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "landing_sides")
    lines.hint("rebalance").write.text(f"{landing}/batch=0")
    counts = ld.split_landing(spark, f"{landing}/*/*.txt", root)
    good = ld.read_good(spark, root).select(F.lit("good").alias("side"), "event_id", "magnitude", "event_time_utc", F.lit(None).cast("string").alias("line"))
    corrupt = ld.read_corrupt(spark, root).select(F.lit("corrupt").alias("side"), F.lit(None).cast("string").alias("event_id"),
                                                  F.lit(None).cast("double").alias("magnitude"), F.lit(None).cast("string").alias("event_time_utc"), "line")
    counted = F.when(F.col("side") == "good", counts["good"]).otherwise(counts["corrupt"]).cast("long")
    return good.unionByName(corrupt).withColumn("counted", counted)


@register("export_reconciled")
def q_export_reconciled(spark, sf_dir):
    """Runs of two tables, one of them called twice and then replaced: source and target rows of what is published."""
    root, s = fresh_path(spark, "export"), silver_table(spark, sf_dir)
    g = gold(s, stamp=False)
    for run, rows in (("r1", g), ("r1", g), ("r2", g.where("severity = 'MICRO'")), ("r2", g)):
        ex.export_reconciled(rows, root, "gold_insights", run)
    ex.export_reconciled(s, root, "silver_events", "r1")
    ex.export_reconciled(s.where("severity = 'MAJOR'"), root, "silver_events", "r2", mode="overwrite")
    tables = ["gold_insights", "silver_events"]
    there = [ex.read_export(spark, root, t).agg(F.count(F.lit(1)).alias("ROWS")).select(F.lit(t.upper()).alias("TABLE_NAME"), "ROWS") for t in tables]
    runs = reduce(DataFrame.unionByName, [ex.export_runs(spark, root, t) for t in tables])
    return runs.join(reduce(DataFrame.unionByName, there), "TABLE_NAME")


@register("report_chunks")
def q_report_chunks(spark, sf_dir):
    """The complete report lists as text, in chunks of 4,096 characters."""
    return rp.context_chunks(written_ml(spark, sf_dir, with_model=False), 4096)


# ---- the classifier's operators with a model whose values SQL can state -----------------


def threshold_model(spark):
    """A decision tree whose thresholds (magnitude 2, 4, 6.5) and class shares follow from 16 training rows."""
    shares = {1.0: ["NEGLIGIBLE"] * 4, 3.0: ["MICRO"] * 3 + ["MINOR"], 5.0: ["MODERATE"] * 2 + ["STRONG"], 8.0: ["MAJOR"] * 3 + ["CATASTROPHIC"] * 2}
    rows = [(f"t{m}{i}", label, m) for m, labels in shares.items() for i, label in enumerate(labels)]
    flat = spark.createDataFrame(rows, "event_id string, severity string, magnitude double")
    others = {c: F.lit(0.0) for c in FEATURE_COLUMNS if c != "magnitude"}
    return clf.train(flat.withColumns(others), DecisionTreeClassifier(maxDepth=3, labelCol="label", featuresCol="features", seed=clf.MODEL_SEED))


def _tested(spark, s: DataFrame, model) -> DataFrame:
    return clf.predict(model, clf.split_flag(an.scored_base(s)).filter("is_test"))


@register("ml_threshold_scores")
def q_ml_threshold_scores(spark, sf_dir):
    ml = ml_table_with(spark, sf_dir)
    return ml.select("event_id", "severity", "predicted_severity", "prediction_confidence")


def ml_table_with(spark, sf_dir) -> DataFrame:
    return clf.ml_table(silver_table(spark, sf_dir), model=threshold_model(spark), stamp=False)


@register("ml_threshold_report")
def q_ml_threshold_report(spark, sf_dir):
    model = threshold_model(spark)
    report = clf.classification_report(_tested(spark, silver_table(spark, sf_dir), model), clf.class_labels(model))
    return report.select("class_name", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")])


@register("ml_threshold_importance")
def q_ml_threshold_importance(spark, sf_dir):
    """Importances of the tree, beside the number of scorable events it is applied to."""
    scored = an.scored_base(silver_table(spark, sf_dir)).agg(F.count(F.lit(1))).scalar()
    return clf.importance(threshold_model(spark)).select("feature", F.round("importance", 6).alias("importance"), scored.alias("scored_events"))


@register("ml_threshold_review")
def q_ml_threshold_review(spark, sf_dir):
    return topk.ml_review(ml_table_with(spark, sf_dir), 20)


@register("ml_threshold_run")
def q_ml_threshold_run(spark, sf_dir):
    model, s = threshold_model(spark), silver_table(spark, sf_dir)
    record = clf.run_record(model, clf.split_flag(an.scored_base(s)).filter("is_train"), _tested(spark, s, model))
    return record.select("estimator", "training_rows", F.round("accuracy", 6).alias("accuracy"))


@register("dash_threshold_predicted")
def q_dash_threshold_predicted(spark, sf_dir):
    return dashboards.predicted_counts(ml_table_with(spark, sf_dir))


# Boosting rounds of the registered query; ``boosted_estimator`` has 100 by default.
BOOSTING_ROUNDS = 5


@register("ml_boosted_report")
def q_ml_boosted_report(spark, sf_dir):
    """Boosted trees, one binary model a class, in place of the forest: the report's classes and supports, and whether confidences are probabilities."""
    s = silver_table(spark, sf_dir)
    model = clf.train(clf.split_flag(an.scored_base(s)).filter("is_train"), clf.boosted_estimator(BOOSTING_ROUNDS))
    pred = _tested(spark, s, model)
    report = clf.classification_report(pred, clf.class_labels(model))
    sound = pred.agg(F.bool_and(F.col("prediction_confidence").between(1 / 7, 1))).scalar()
    return report.select("class_name", "support", sound.alias("confidences_sound"))


@register("ml_scored_stream")
def q_ml_scored_stream(spark, sf_dir):
    """The saved model, loaded again, scores Silver rows as they arrive as a stream."""
    path, out = fresh_path(spark, "models"), fresh_path(spark, "ml_scored")
    clf.save_model(threshold_model(spark), path)
    s = silver_table(spark, sf_dir)
    events = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", sb.files_per_batch(len(s.inputFiles()), POLLS)).parquet(
        *{f.rsplit("/", 1)[0] for f in s.inputFiles()})
    clf.scored_stream(clf.load_model(path), events, out, fresh_path(spark, "ckpt_scored")).awaitTermination()
    return spark.read.parquet(out).select("event_id", "severity", "predicted_severity", "prediction_confidence")


@register("severity_distribution")
def q_severity_distribution(spark, sf_dir):
    return profiles.severity_distribution(an.scored_base(silver_of(spark, sf_dir)))


@register("ml_run")
def q_ml_run(spark, sf_dir):
    s = silver_table(spark, sf_dir)
    model = trained_model(spark, sf_dir, s)
    feats = clf.split_flag(an.scored_base(s))
    pred = clf.predict(model, feats.filter("is_test"))
    rec = clf.run_record(model, feats.filter("is_train"), pred)
    path = fresh_path(spark, "ml_runs")
    rec.write.mode("append").parquet(path)
    clf.save_model(model, fresh_path(spark, "models"))
    return spark.read.parquet(path)


@register("gold_context")
def q_gold_context(spark, sf_dir):
    return rp.gold_context(gold_of(spark, sf_dir))


# ---- the same operators, reduced to what SQL can state ------------------------------


@register("ml_report_support")
def q_ml_report_support(spark, sf_dir):
    """The classification report's rows and supports (the metrics depend on the model)."""
    return q_ml_report(spark, sf_dir).select("class_name", "support")


@register("ml_run_facts")
def q_ml_run_facts(spark, sf_dir):
    return q_ml_run(spark, sf_dir).select("estimator", "features", "training_rows")


@register("ml_importance_facts")
def q_ml_importance_facts(spark, sf_dir):
    return q_ml_importance(spark, sf_dir).agg(F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"),
                                              F.round(F.sum("importance"), 6).alias("total"))


@register("ml_review_facts")
def q_ml_review_facts(spark, sf_dir):
    return topk.ml_review(ml_of(spark, sf_dir), 20).drop("predicted_severity", "confidence_pct")


@register("qa_context_facts")
def q_qa_context_facts(spark, sf_dir):
    return rp.qa_context(written_ml(spark, sf_dir, with_model=False)).drop("predicted_severity", "prediction_confidence")


@register("dash_predicted_total")
def q_dash_predicted_total(spark, sf_dir):
    counts = q_dash_predicted(spark, sf_dir)
    return counts.agg(F.sum("events").alias("events"), F.sum(F.when(F.col("predicted_severity").isNull(), F.col("events"))).alias("unscored"))


def _plain_history(spark, sf_dir) -> DataFrame:
    """History of reports without a classifier, written and read back."""
    path = fresh_path(spark, "report_history")
    rp.append_history(rp.render_reports(written_ml(spark, sf_dir, with_model=False)), path)
    return spark.read.parquet(path)


@register("report_preview")
def q_report_preview(spark, sf_dir):
    return rp.report_history(_plain_history(spark, sf_dir)).drop("generated_at")


@register("dash_report_text")
def q_dash_report_text(spark, sf_dir):
    return dashboards.report_table(_plain_history(spark, sf_dir))


@register("landing_count")
def q_landing_count(spark, sf_dir):
    landing = land_feed(spark, sf_dir)
    named = ld.list_landing(spark, landing).agg(F.min(F.col("size_bytes") > 0).alias("all_have_bytes"))
    return named.withColumn("records", ld.read_landing(spark, landing).agg(F.count(F.lit(1))).scalar())


@register("bronze_metadata")
def q_bronze_metadata(spark, sf_dir):
    """Ingest metadata of the Bronze stream: stamps and source files."""
    b = spark.read.parquet(_run_bronze(spark, sf_dir))
    return b.agg(F.count(F.lit(1)).alias("rows"), F.count("bronze_load_timestamp").alias("stamped"),
                 F.count_if(F.col("source_file").rlike(r"/batch=[^/]+/[^/]+\.json$")).alias("from_landed_files"))


@register("gold_sorted")
def q_gold_sorted(spark, sf_dir):
    """Gold in the table's own order (newest hour, then strongest first)."""
    return gold(silver_of(spark, sf_dir), stamp=False, sort=True)


@register("ml_joined")
def q_ml_joined(spark, sf_dir):
    """Silver left-joined with a table of predictions made elsewhere."""
    s = silver_table(spark, sf_dir)
    made = clf.ml_table(s, stamp=False).where("is_anomaly is not null").select("event_id", "is_anomaly", "anomaly_reason", "anomaly_score")
    return clf.enrich(s, made, stamp=False).select("event_id", "severity", "region", "is_anomaly", "anomaly_reason", "anomaly_score")
