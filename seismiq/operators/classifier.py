"""Severity classifier on Spark ML, evaluation, and the ML-enriched table.

Training, evaluation and scoring are distributed Spark ML / DataFrame work;
only model metadata (class labels, 12 importances) is small driver data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources.schemas import FEATURE_COLUMNS
from .anomaly import (ANOMALY_FEATURES, SCORE_FILLS, anomaly_columns, feature_stats,
                      scorable, scored_base, with_stats, zscore_columns)

# ---- fixed values -------------------------------------------------------------
SPLIT_SEED = "42"
TEST_FRACTION = 0.2
MIN_SPLIT_ROWS = 10          # below this, train and test are both the whole set
N_TREES = 100
MAX_DEPTH = 4
LEARNING_RATE = 0.1          # used by the boosted option
MODEL_SEED = 42
# --------------------------------------------------------------------------------

# Spark ML trees reject null/NaN features.  The vector reads private copies
# of the features with the scoring fills applied; position is never filled
# by the scoring rules, so it is filled with 0 for the vector only.
_VECTOR_FILLS = dict(SCORE_FILLS, latitude=0.0, longitude=0.0, tsunami_flag=0)


def _vcol(c: str) -> str:
    return f"_v_{c}"


def split_threshold(frac: float) -> int:
    """Bound of the first hash byte: values below it form the test split."""
    return min(256, round(frac * 256))


def split_flag(df: DataFrame, key: str = "event_id", seed: str = SPLIT_SEED,
               frac: float = TEST_FRACTION) -> DataFrame:
    """Add ``is_test`` / ``is_train``: a stable hash split on ``key``.

    The assignment depends only on the key (not on partitioning or order), so
    it survives task retries and re-partitioning and needs no global sort.
    With fewer than ``MIN_SPLIT_ROWS`` rows every row is in both splits; the
    row count is a scalar subquery (computed once), not a driver round trip.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), 1, 2), 16, 10).cast("int")
    in_test = h < F.lit(split_threshold(frac))
    n = df.agg(F.count(F.lit(1))).scalar()
    small = n < MIN_SPLIT_ROWS
    return df.withColumns({"is_test": small | in_test, "is_train": small | ~in_test})


def vector_input(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Add the filled, double-typed ``_v_<feature>`` columns the vector reads."""
    cols = {}
    for c in features:
        x = F.col(c).cast("int") if c == "tsunami_flag" else F.col(c)
        x = x.cast("double")
        if c in _VECTOR_FILLS:
            x = F.coalesce(x, F.lit(float(_VECTOR_FILLS[c])))
        cols[_vcol(c)] = x
    return df.withColumns(cols)


def build_pipeline(estimator=None, features: Sequence[str] = FEATURE_COLUMNS) -> Pipeline:
    """Label encoder (alphabetical) -> 12-feature vector -> estimator."""
    indexer = StringIndexer(inputCol="severity", outputCol="label",
                            stringOrderType="alphabetAsc", handleInvalid="keep")
    assembler = VectorAssembler(inputCols=[_vcol(c) for c in features], outputCol="features",
                                handleInvalid="keep")
    if estimator is None:
        estimator = RandomForestClassifier(numTrees=N_TREES, maxDepth=MAX_DEPTH, seed=MODEL_SEED,
                                           featureSubsetStrategy="all",
                                           labelCol="label", featuresCol="features")
    return Pipeline(stages=[indexer, assembler, estimator])


def boosted_estimator(max_iter: int = N_TREES, parallelism: int = 4):
    """Gradient-boosted trees: one binary model per class, fitted side by side.

    ``predict`` turns the margins of the binary models into class
    probabilities that add up to one.
    """
    gbt = GBTClassifier(maxDepth=MAX_DEPTH, stepSize=LEARNING_RATE, maxIter=max_iter, seed=MODEL_SEED)
    return OneVsRest(classifier=gbt, labelCol="label", featuresCol="features", parallelism=parallelism)


def train(train_df: DataFrame, estimator=None, materialize: bool = True,
          max_rows: int | None = None) -> PipelineModel:
    """Fit the pipeline.  The label encoder, split finding and bagging each
    pass over the input, so it is first written once as Parquet to the shared
    folder (lineage is cut, a lost executor does not redo the upstream work)
    instead of recomputing the upstream dedup on every pass.

    ``max_rows`` bounds the labelled rows of the fit (for boosting, whose
    rounds follow one another): about so many rows, chosen by a hash of the
    event id.  All rows are used by default.
    """
    df = vector_input(train_df)
    if max_rows is not None:
        n = train_df.count()
        share = min(1.0, max_rows / n) if n else 1.0
        df = df.filter(F.pmod(F.xxhash64("event_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    if materialize:
        spark = df.sparkSession
        path = fresh_path(spark, "training_set")
        df.write.parquet(path)
        df = spark.read.parquet(path)
    return build_pipeline(estimator).fit(df)


def class_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``predicted_severity`` and ``prediction_confidence`` (4 decimals, half-even)."""
    labels = class_labels(model)
    out = model.transform(vector_input(df))
    decoded = F.try_element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    cols = {"predicted_severity": decoded}
    if "probability" in out.columns:
        cols["prediction_confidence"] = F.bround(F.array_max(vector_to_array("probability")), 4)
    elif isinstance(model.stages[-1], OneVsRestModel):
        # log-loss margins: a binary model's probability is 1 / (1 + exp(-2 margin))
        each = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
        total = F.aggregate(each, F.lit(0.0), lambda a, p: a + p)
        cols["prediction_confidence"] = F.bround(F.array_max(each) / total, 4)
    else:
        cols["prediction_confidence"] = F.lit(None).cast("double")
    keep = [c for c in df.columns]
    return out.withColumns(cols).select(*keep, "label", "prediction", *cols.keys())


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg(F.avg((F.col("severity") == F.col("predicted_severity")).cast("double"))
                    .alias("accuracy"))


def classification_report(pred: DataFrame, labels: Sequence[str],
                          actual: str = "severity", predicted: str = "predicted_severity") -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro and
    weighted averages; zero division gives 0.

    One aggregation reduces the predictions to confusion cells, one per
    (actual, predicted) pair -- at most (classes + 1)^2 of them, bounded by
    the label set and not by the data -- gathered into a single row.  Every
    metric is then computed from that row with higher-order functions, so
    the predictions are evaluated once.
    """
    cells = (pred.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")))
    conf = cells.agg(F.collect_list(F.struct("a", "p", "n")).alias("m"))
    classes = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("class_name"))
                        for i, c in enumerate(labels)])
    zero, dz = F.lit(0).cast("bigint"), F.lit(0.0)

    def total(cond) -> Column:
        return F.aggregate(F.filter("m", cond), zero, lambda acc, x: acc + x["n"])

    def ratio(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), dz)

    counts = F.transform(classes, lambda k: F.struct(
        k["ord"].alias("ord"), k["class_name"].alias("class_name"),
        total(lambda x: x["a"] == k["class_name"]).alias("support"),
        total(lambda x: x["p"] == k["class_name"]).alias("npred"),
        total(lambda x: (x["a"] == k["class_name"]) & (x["p"] == k["class_name"])).alias("tp")))
    per_class = F.transform(counts, lambda c: F.struct(
        c["ord"].alias("ord"), c["class_name"].alias("class_name"),
        ratio(c["tp"], c["npred"]).alias("precision"),
        ratio(c["tp"], c["support"]).alias("recall"),
        c["support"].alias("support"), c["tp"].alias("tp")))
    scored = F.transform(per_class, lambda c: F.struct(
        c["ord"].alias("ord"), c["class_name"].alias("class_name"),
        c["precision"].cast("double").alias("precision"), c["recall"].cast("double").alias("recall"),
        ratio(2 * c["precision"] * c["recall"], c["precision"] + c["recall"]).alias("f1_score"),
        c["support"].alias("support")))

    def fold(field: str, weighted: bool = False) -> Column:
        return F.aggregate("_rows", dz, lambda acc, x: acc + (
            x[field] * x["support"] if weighted else x[field]))

    n_cls = len(labels)
    row = F.struct  # readability below

    def summary(i: int, name: str, p_: Column, r_: Column, f_: Column) -> Column:
        return row(F.lit(i).alias("ord"), F.lit(name).alias("class_name"),
                   p_.cast("double").alias("precision"), r_.cast("double").alias("recall"),
                   f_.cast("double").alias("f1_score"), F.col("_support").alias("support"))

    out = (conf.select(scored.alias("_rows"),
                       F.aggregate(per_class, zero, lambda a, x: a + x["support"]).alias("_support"),
                       F.aggregate(per_class, zero, lambda a, x: a + x["tp"]).alias("_tp"))
               .select("_rows", "_support", "_tp",
                       F.array(
                           summary(n_cls, "accuracy", F.lit(None), F.lit(None),
                                   ratio(F.col("_tp"), F.col("_support"))),
                           summary(n_cls + 1, "macro avg", ratio(fold("precision"), F.size("_rows")),
                                   ratio(fold("recall"), F.size("_rows")),
                                   ratio(fold("f1_score"), F.size("_rows"))),
                           summary(n_cls + 2, "weighted avg",
                                   ratio(fold("precision", True), F.col("_support")),
                                   ratio(fold("recall", True), F.col("_support")),
                                   ratio(fold("f1_score", True), F.col("_support"))),
                       ).alias("_summary")))
    return out.select(F.inline(F.concat("_rows", "_summary")))


def importance(model: PipelineModel, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Feature importance table (12 rows), most important first."""
    est = model.stages[-1]
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    # boosted: the mean of the binary models' importances
    models = est.models if isinstance(est, OneVsRestModel) else [est]
    each = [m.featureImportances.toArray() for m in models]
    vals = [sum(float(e[i]) for e in each) / len(each) for i in range(len(features))]
    return (spark.createDataFrame(list(zip(features, vals)),
                                  "feature string, importance double")
                 .orderBy(F.col("importance").desc_nulls_last(), "feature"))


# ---- ML-enriched table ------------------------------------------------------------

# ---- fixed values: columns added to Silver ------------------------------------
ML_COLUMNS = ["predicted_severity", "prediction_confidence", "is_anomaly", "anomaly_reason",
              "anomaly_score", "zscore_magnitude", "zscore_depth_km", "zscore_significance"]
# --------------------------------------------------------------------------------


def _filled(c: str, df: DataFrame) -> Column:  # scoring fill of one column
    if c in SCORE_FILLS:
        return F.coalesce(F.col(c), F.lit(SCORE_FILLS[c]).cast(df.schema[c].dataType))
    return F.col(c)


def ml_table(silver: DataFrame, model: PipelineModel | None = None,
             run_id: str | None = None, stamp: bool = True) -> DataFrame:
    """Silver + prediction and anomaly columns, one row per event.

    Equivalent to Silver LEFT JOIN (predictions of the scorable events) on
    ``event_id`` -- but since both sides are the same Silver rows, it is
    computed as a projection: scored values where the event is scorable, null
    elsewhere.  No join, no shuffle of Silver; the only extra work is the
    one-row statistics aggregate.
    """
    ok = scorable(silver)
    stats = feature_stats(scored_base(silver))
    df = with_stats(silver, stats)
    src = {c: _filled(c, silver) for c in ANOMALY_FEATURES}
    df = df.withColumns(zscore_columns(ANOMALY_FEATURES, src))
    df = df.withColumns(anomaly_columns(ANOMALY_FEATURES))
    if model is not None:
        df = predict(model, df).select(*df.columns, "predicted_severity", "prediction_confidence")
    else:
        df = df.withColumns({"predicted_severity": F.lit(None).cast("string"),
                             "prediction_confidence": F.lit(None).cast("double")})
    out = df.withColumns({c: F.when(ok, F.col(c)) for c in ML_COLUMNS})
    out = out.select(*silver.columns, *ML_COLUMNS)
    if stamp:
        out = out.withColumns({"ml_load_timestamp": F.current_timestamp(),
                               "model_run_id": F.lit(run_id or uuid.uuid4().hex)})
    return out


def enrich(silver: DataFrame, predictions: DataFrame, run_id: str | None = None,
           stamp: bool = True) -> DataFrame:
    """Silver LEFT JOIN an externally produced predictions table on ``event_id``.

    Use when predictions come from elsewhere (another job or model); events
    without a prediction keep null prediction columns.
    """
    out = silver.join(predictions, "event_id", "left")
    if stamp:
        out = out.withColumns({"ml_load_timestamp": F.current_timestamp(),
                               "model_run_id": F.lit(run_id or uuid.uuid4().hex)})
    return out


def run_record(model: PipelineModel, train_df: DataFrame, test_pred: DataFrame,
               run_id: str | None = None, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """One-row run record: parameters, features, training rows, accuracy, user.

    Training rows and accuracy are aggregates over the splits, joined into a
    single row without leaving the cluster.
    """
    est = model.stages[-1]
    params = {p.name: v for p, v in est.extractParamMap().items()
              if p.name in ("numTrees", "maxDepth", "seed", "stepSize", "maxIter", "featureSubsetStrategy")}
    rows = train_df.agg(F.count(F.lit(1)).alias("training_rows"))
    acc = accuracy(test_pred).scalar()
    return rows.withColumn("accuracy", acc).select(
        F.lit(run_id or uuid.uuid4().hex).alias("run_id"),
        F.lit(type(est).__name__).alias("estimator"),
        F.to_json(F.create_map(*[x for k, v in sorted(params.items()) for x in (F.lit(k), F.lit(str(v)))]))
         .alias("params"),
        F.lit(",".join(features)).alias("features"),
        "training_rows", "accuracy",
        F.current_user().alias("run_by"),
        F.current_timestamp().alias("created_at"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def scored_stream(model: PipelineModel, events: DataFrame, out: str, checkpoint: str, trigger: str | None = None):
    """Score a stream of Silver rows with a fitted (saved and loaded) model: append the scorable events to ``out``.

    Scoring is a projection, so the stream keeps no state; a new model takes
    effect with the next start of the query.
    """
    rows = predict(model, scored_base(events))
    w = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    return w.start(out)
