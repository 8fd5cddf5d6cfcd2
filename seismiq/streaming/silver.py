"""Streaming Silver and Gold as versions of their date partitions.

Latest-version-per-event is a streaming aggregation: Spark's state store holds
the newest version of each event and the dates its versions had, keyed by
event id, so a micro-batch reads the state of its own events and no history.
The aggregation runs in update mode; ``foreachBatch`` receives the changed
events.

A batch N writes new folders ``silver/v=N/event_date=D``: the changed events, and
the other rows of those folders that held a changed event, which they replace.
Folders without one stay in use, so a batch's work follows its own events; a date
with ``MAX_FOLDERS`` of them is written as one.  Gold's folders of the dates that
the events had and have are replaced.  Nothing that a reader may be using is touched.
The manifest (``sources.versions``) then switches all these folders, of Silver and
Gold, at once.  A batch that fails before that leaves the tables as they were;
its replay writes the same folders again, and the replay of a published batch
does nothing.  Folders that the last ``KEEP`` manifests do not name are deleted.

Gold is kept by retraction: the change of a batch is the rows that events had
before it and have after it, and a group's counts and sums move by their
difference.  Maximum, minimum and notable place of a group follow from what was
added, unless the retracted rows held them: only those groups are computed again
from the Silver rows of their dates.  Sums are decimals, so that a retraction
leaves no rounding behind (values are taken to 9 decimal places).

Events whose time is missing or does not parse have a null date, which is a
partition like any other.  At scale choose the RocksDB state store provider
(``spark.sql.streaming.stateStore.providerClass``) in the session.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.timefmt import hour_of, parse_iso_utc
from ..operators.dedup import BRONZE_ORDER, version_order
from ..operators.silver import classify, project_silver
from ..sources import versions as vs
from ..sources.schemas import FEED_SCHEMA

BRONZE_SCHEMA = T.StructType(FEED_SCHEMA.fields + [
    T.StructField("bronze_load_timestamp", T.TimestampType()),
    T.StructField("source_file", T.StringType()),
])
DATE = "event_date"
DATED_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + [T.StructField(DATE, T.DateType())])
NO_DATE, NULL_FOLDER = "none", "__HIVE_DEFAULT_PARTITION__"
KEEP = 2
# folders of a date before they are written as one
MAX_FOLDERS = 8

GROUP = ["event_hour", "severity", "region"]
SUM_TYPE = "decimal(28, 9)"
# sums move by the difference of what was and what is; extremes do not
SUMS = ["total_events", "mag_sum", "mag_n", "depth_sum", "depth_n", "tsunami_count", "alerted_events"]
EXTREMES = {"max_magnitude": F.max, "min_magnitude": F.min, "max_significance": F.max, "notable": F.max}
_SUM = T.DecimalType(38, 9)
GOLD_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("event_hour", T.TimestampNTZType()), ("severity", T.StringType()), ("region", T.StringType()), ("total_events", T.LongType()),
    ("mag_sum", _SUM), ("mag_n", T.LongType()), ("depth_sum", _SUM), ("depth_n", T.LongType()), ("tsunami_count", T.LongType()),
    ("alerted_events", T.LongType()), ("max_magnitude", T.DoubleType()), ("min_magnitude", T.DoubleType()), ("max_significance", T.IntegerType()),
    ("notable", T.StructType([T.StructField("magnitude", T.DoubleType()), T.StructField("event_id", T.StringType()), T.StructField("place", T.StringType())])),
    (DATE, T.DateType()))])


def _date_name(date: Column | str = DATE) -> Column:
    """A date as text, with a name for the missing one."""
    return F.coalesce((F.col(date) if isinstance(date, str) else date).cast("string"), F.lit(NO_DATE))


def latest_events(bronze: DataFrame) -> DataFrame:
    """Streaming (or batch) Bronze rows -> per event ``latest`` (struct) and ``dates`` of all its versions."""
    rows = (bronze.filter(F.col("event_id").isNotNull())
                  .withColumn(DATE, F.to_date(parse_iso_utc("event_time_utc"))))
    # the values that order versions come first, so the largest is the latest and the state holds none of them twice
    version = F.struct(*version_order(BRONZE_ORDER), *[F.col(c) for c in DATED_SCHEMA.names if c not in BRONZE_ORDER])
    return rows.groupBy("event_id").agg(F.max(version).alias("latest"), F.collect_set(_date_name()).alias("dates"))


# ---- reading -----------------------------------------------------------------


class Folder(NamedTuple):
    """A folder in use: the manifest's entries."""

    layer: str
    date: str
    version: int

    @property
    def name(self) -> str:
        return f"{self.layer}/v={self.version}/{DATE}={NULL_FOLDER if self.date == NO_DATE else self.date}"


def _read_folders(spark: SparkSession, root: str, layer: str, folders: list[Folder], schema: T.StructType, *keep: str) -> DataFrame:
    """Rows of the layer's folders among those given; ``keep`` may name ``v``, the folder's version."""
    paths = [f"{root}/{f.name}" for f in folders if f.layer == layer]
    with_version = T.StructType(schema.fields + [T.StructField("v", T.IntegerType())])
    if not paths:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in with_version.fields]).select(*schema.names, *keep)
    return spark.read.schema(with_version).option("basePath", f"{root}/{layer}").parquet(*paths).select(*schema.names, *keep)


def _folders(spark: SparkSession, root: str, version: int | None) -> list[Folder]:
    return [Folder(*e) for e in vs.manifest(spark, root, version)]


def _read_layer(spark: SparkSession, root: str, layer: str, schema: T.StructType, version: int | None) -> DataFrame:
    root = root.rstrip("/")
    version = vs.latest(spark, root) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no version is published under {root}")
    return _read_folders(spark, root, layer, _folders(spark, root, version), schema)


def read_silver(spark: SparkSession, root: str, stamp: bool = True, version: int | None = None) -> DataFrame:
    """The streamed Silver table with parsed time and labels, as last published or of a kept version."""
    return project_silver(_read_layer(spark, root, "silver", DATED_SCHEMA, version).drop(DATE), stamp=stamp)


def read_gold(spark: SparkSession, root: str, version: int | None = None, dated: bool = False) -> DataFrame:
    """The streamed Gold table, as last published or of a kept version; ``dated`` keeps the partition's date."""
    rows = _read_layer(spark, root, "gold", GOLD_SCHEMA, version)

    def mean(name: str) -> Column:
        return F.round(F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n")), 2)

    return rows.select(*GROUP, "total_events", F.col("total_events").alias("unique_events"), mean("mag").alias("avg_magnitude"),
                       "max_magnitude", "min_magnitude", mean("depth").alias("avg_depth_km"), "tsunami_count", "alerted_events",
                       "max_significance", F.col("notable.place").alias("most_notable_place"), *([DATE] if dated else []))


# ---- Gold by retraction --------------------------------------------------------


def contributions(silver_rows: DataFrame, *keep: str) -> DataFrame:
    """Each event as a Gold group of its own: (event_id, own: the group's columns), with the columns ``keep``."""
    rows = classify(silver_rows)

    def number(flag: Column) -> Column:
        return F.when(flag, 1).otherwise(0).cast("bigint")

    def amount(name: str) -> Column:
        return F.coalesce(F.col(name).cast(SUM_TYPE), F.lit(0)).cast(SUM_TYPE)

    own = {"event_hour": hour_of("event_timestamp"), "severity": F.col("severity"), "region": F.col("region"),
           "total_events": F.lit(1).cast("bigint"), "mag_sum": amount("magnitude"), "mag_n": number(F.col("magnitude").isNotNull()),
           "depth_sum": amount("depth_km"), "depth_n": number(F.col("depth_km").isNotNull()),
           "tsunami_count": number(F.col("tsunami_flag") == F.lit(True)), "alerted_events": number(F.col("alert_level") != F.lit("none")),
           "max_magnitude": F.col("magnitude"), "min_magnitude": F.col("magnitude"), "max_significance": F.col("significance"),
           "notable": F.struct("magnitude", "event_id", "place")}
    return rows.select("event_id", F.struct(*[c.alias(n) for n, c in own.items()]).alias("own"), *keep)


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What the changed events take away (``side`` -1) and bring (1); nothing for an event that brings what it brought."""
    pairs = after.join(before.withColumnRenamed("own", "was"), "event_id", "left").where(~F.col("own").eqNullSafe(F.col("was")))
    sides = F.array(F.struct(F.lit(1).alias("side"), F.col("own").alias("g")), F.struct(F.lit(-1).alias("side"), F.col("was").alias("g")))
    return pairs.select(F.explode(sides).alias("s")).where("s.g is not null").select("s.g.*", "s.side")


def retracted(held: DataFrame, changes: DataFrame) -> DataFrame:
    """Gold groups moved by signed changes: sums by their difference, extremes by what was brought.

    ``stale`` marks groups that lost the row of one of their extremes; their
    extremes are not known from the change.
    """
    rows = held.select(*GROUP, *SUMS, *EXTREMES, F.lit(1).alias("side")).unionByName(changes)
    there, gone = F.col("side") > 0, F.col("side") < 0
    sums = [F.sum(F.col(c) * F.col("side")).cast(GOLD_SCHEMA[c].dataType).alias(c) for c in SUMS]
    best = [f(F.when(there, F.col(c))).alias(c) for c, f in EXTREMES.items()]
    last = [f(F.when(gone, F.col(c))).alias(f"gone_{c}") for c, f in EXTREMES.items()]
    out = rows.groupBy(*GROUP).agg(*sums, *best, *last)
    reached = F.lit(False)
    for c, f in EXTREMES.items():
        worse = F.col(f"gone_{c}") < F.col(c) if f is F.max else F.col(f"gone_{c}") > F.col(c)
        reached = reached | (F.col(f"gone_{c}").isNotNull() & ~F.coalesce(worse, F.lit(False)))
    return out.where("total_events > 0").select(*GROUP, *SUMS, *EXTREMES, reached.alias("stale"), F.to_date("event_hour").alias(DATE))


def group_sums(rows: DataFrame) -> DataFrame:
    """Contributions -> the columns of their Gold groups, from all events of the groups."""
    g = rows.select("own.*").groupBy(*GROUP)
    return g.agg(*[F.sum(c).cast(GOLD_SCHEMA[c].dataType).alias(c) for c in SUMS], *[f(c).alias(c) for c, f in EXTREMES.items()]) \
            .withColumn(DATE, F.to_date("event_hour"))


def _write_gold(spark: SparkSession, root: str, batch_id: int, held: DataFrame, before: DataFrame, after: DataFrame, silver: list[Folder]) -> dict:
    """Write the Gold folders of the batch, whose Silver is in the folders given; returns how much was computed again."""
    moved = _staged(spark, retracted(held, signed_changes(before, after)), f"{root}/changes/gold_v={batch_id}")
    per_date = moved.groupBy(_date_name().alias("date")).agg(F.count("*").alias("groups"), F.count_if("stale").alias("stale")).collect()
    dates = {r.date for r in per_date if r.stale}
    out = moved.where("not stale").select(*GOLD_SCHEMA.names)
    if dates:
        stale = moved.where("stale").select(*GROUP)
        rows = contributions(_read_folders(spark, root, "silver", [f for f in silver if f.date in dates], DATED_SCHEMA))
        same = F.lit(True)
        for c in GROUP:
            same = same & F.col(f"own.{c}").eqNullSafe(stale[c])
        out = out.unionByName(group_sums(rows.join(stale, same, "left_semi")).select(*GOLD_SCHEMA.names))
    out.hint("rebalance", DATE).write.mode("overwrite").partitionBy(DATE).parquet(f"{root}/gold/v={batch_id}")
    return {"groups": sum(r.groups for r in per_date), "stale_groups": sum(r.stale for r in per_date), "silver_dates_read": len(dates)}


# ---- a batch ---------------------------------------------------------------------


def _staged(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read from there."""
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _written(spark: SparkSession, root: str, layer: str, batch_id: int) -> list[Folder]:
    """The folders that the batch wrote."""
    names = [n.split("=", 1)[1] for n in vs.folders(spark, f"{root}/{layer}/v={batch_id}") if n.startswith(f"{DATE}=")]
    return [Folder(layer, NO_DATE if n == NULL_FOLDER else n, batch_id) for n in names]


def _vacuum(spark: SparkSession, root: str) -> None:
    """Delete folders and manifests that no kept version names."""
    versions = vs.published(spark, root)
    in_use = {f for v in versions[-KEEP:] for f in _folders(spark, root, v)}
    for old in versions[:-KEEP]:
        for f in set(_folders(spark, root, old)) - in_use:
            vs.delete(spark, f"{root}/{f.name}")
        for name in ("v", "held_v", "gold_v"):
            vs.delete(spark, f"{root}/changes/{name}={old}")
        vs.retire(spark, root, old)


def _writer(spark: SparkSession, root: str, with_gold: bool = True, before_publish: Callable[[int], None] | None = None):
    """Only the changes are written in the stream's own session: in the caller's, adaptive execution sizes the folders."""
    root = root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # a replay runs the aggregation again (the state store commits it) and gets the same rows
        path = f"{root}/changes/v={batch_id}"
        batch.select("latest", "dates").write.mode("overwrite").parquet(path)
        if vs.is_published(spark, root, batch_id):
            return
        changed = spark.read.parquet(path)
        # names of dates, as many as the calendar has
        touched = {r[0] for r in changed.select(F.explode("dates")).distinct().collect()}
        folders = _folders(spark, root, vs.latest(spark, root))
        silver = [f for f in folders if f.layer == "silver"]
        moved = [f for f in silver if f.date in touched]
        after = changed.select("latest.*").select(*DATED_SCHEMA.names)
        # a join of few columns finds the changed events that are held, and their folders
        held = _read_folders(spark, root, "silver", moved, DATED_SCHEMA, "v")
        own = contributions(held, "v", DATE) if with_gold else held.select("event_id", "v", DATE)
        before = _staged(spark, own.join(after.select("event_id"), "event_id", "left_semi"), f"{root}/changes/held_v={batch_id}")
        hit = {Folder("silver", r.date, r.v) for r in before.select(_date_name().alias("date"), "v").distinct().collect()}
        of_date = Counter(f.date for f in moved)
        replaced = {f for f in moved if f in hit or of_date[f.date] >= MAX_FOLDERS}
        rest = _read_folders(spark, root, "silver", sorted(replaced), DATED_SCHEMA).join(before.select("event_id"), "event_id", "left_anti")
        rows = rest.select(*DATED_SCHEMA.names).unionByName(after)
        # a hot date is split over several tasks, small ones share one
        rows.hint("rebalance", DATE).write.mode("overwrite").partitionBy(DATE).parquet(f"{root}/silver/v={batch_id}")
        silver = [f for f in silver if f not in replaced] + _written(spark, root, "silver", batch_id)
        gold, stats = [f for f in folders if f.layer == "gold" and f.date not in touched], {"groups": 0, "stale_groups": 0, "silver_dates_read": 0}
        if with_gold:
            gold_rows = _read_folders(spark, root, "gold", [f for f in folders if f.date in touched], GOLD_SCHEMA)
            stats = _write_gold(spark, root, batch_id, gold_rows, before.select("event_id", "own"), contributions(after), silver)
            gold += _written(spark, root, "gold", batch_id)
        if before_publish:
            before_publish(batch_id)
        record = json.dumps({"batch_id": batch_id, "dates": len(touched), **stats})
        vs.write_text(spark, f"{root}/batches/{batch_id}.json", record)
        vs.publish(spark, root, batch_id, [*silver, *gold])
        _vacuum(spark, root)
    return write_batch


BATCHES = "batch_id int, dates bigint, groups bigint, stale_groups bigint, silver_dates_read bigint"


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """A row for each batch: dates and Gold groups it moved, groups computed again and from how many dates of Silver."""
    return spark.read.schema(BATCHES).json(f"{root.rstrip('/')}/batches")


def start_silver(spark: SparkSession, bronze_path: str, root: str, checkpoint: str,
                 trigger: str | None = None, max_files: int | None = None, with_gold: bool = False,
                 before_publish: Callable[[int], None] | None = None) -> StreamingQuery:
    """Bronze table (as a stream) -> versions of Silver, and with ``with_gold`` of Gold, under ``root``.

    A root belongs to one checkpoint: its versions are the checkpoint's batch ids.
    ``max_files`` bounds a micro-batch (all available files by default);
    ``trigger=None`` processes what is available and stops.  ``before_publish``
    is called with the batch id when a batch is staged but not yet visible.
    """
    r = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    w = (latest_events(r.parquet(bronze_path)).writeStream.outputMode("update")
          .foreachBatch(_writer(spark, root, with_gold, before_publish))
          .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    return w.start()
