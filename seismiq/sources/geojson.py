"""Raw GeoJSON feed documents -> 25-column feed records.

The flatten is a DataFrame plan (explode + struct field access), so documents
are parsed and flattened on the executors.  Published feed files hold one
pretty-printed document each (``multiline=True``: one task per file, files in
parallel); documents written one per line (``multiline=False``) are also
split within a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import iso_utc_text, now_utc
from .adapter import FEED_SOURCE
from .schemas import FEED_COLUMNS, GEOJSON_SCHEMA


def now_iso_utc() -> Column:
    """Wall clock of the run as ISO text with ``Z`` (fetch time)."""
    return F.concat(F.date_format(now_utc(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def flatten(docs: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """FeatureCollection rows -> one feed record per feature.

    Missing properties, a null geometry or fewer than three coordinates give
    null fields; the feature is kept (one bad feature never loses a batch).
    """
    f = F.col("f")
    p = f["properties"]
    coords = f["geometry"]["coordinates"]
    return (docs.select(F.explode("features").alias("f"))
                .select(
                    f["id"].alias("event_id"),
                    F.lit(FEED_SOURCE).alias("source"),
                    p["mag"].alias("magnitude"),
                    p["magType"].alias("magnitude_type"),
                    F.get(coords, 2).alias("depth_km"),
                    F.get(coords, 1).alias("latitude"),
                    F.get(coords, 0).alias("longitude"),
                    p["place"].alias("place"),
                    p["type"].alias("event_type"),
                    p["time"].alias("event_time_epoch_ms"),
                    iso_utc_text(p["time"]).alias("event_time_utc"),
                    p["alert"].alias("alert_level"),
                    F.coalesce(p["tsunami"] != 0, F.lit(False)).alias("tsunami_flag"),
                    p["sig"].alias("significance"),
                    p["felt"].alias("felt_reports"),
                    p["cdi"].alias("cdi"),
                    p["mmi"].alias("mmi"),
                    p["status"].alias("status"),
                    p["net"].alias("network"),
                    p["gap"].alias("gap_deg"),
                    p["rms"].alias("rms"),
                    p["nst"].alias("nst"),
                    p["detail"].alias("detail_url"),
                    p["url"].alias("event_url"),
                    (ingested_at if ingested_at is not None else now_iso_utc()).alias("ingestion_timestamp_utc"),
                )
                .select(*FEED_COLUMNS))


def read_geojson(spark: SparkSession, path: str, multiline: bool = True,
                 ingested_at: Column | None = None) -> DataFrame:
    docs = (spark.read.schema(GEOJSON_SCHEMA).option("multiLine", multiline)
                 .option("mode", "PERMISSIVE").json(path))
    return flatten(docs, ingested_at)


def to_features(feed: DataFrame) -> DataFrame:
    """Feed records -> GeoJSON Feature structs (inverse of ``flatten``)."""
    props = F.struct(
        F.col("magnitude").alias("mag"), F.col("magnitude_type").alias("magType"),
        F.col("place").alias("place"), F.col("event_type").alias("type"),
        F.col("event_time_epoch_ms").alias("time"), F.col("alert_level").alias("alert"),
        F.col("tsunami_flag").cast("int").alias("tsunami"), F.col("significance").alias("sig"),
        F.col("felt_reports").alias("felt"), F.col("cdi").alias("cdi"), F.col("mmi").alias("mmi"),
        F.col("status").alias("status"), F.col("network").alias("net"), F.col("gap_deg").alias("gap"),
        F.col("rms").alias("rms"), F.col("nst").alias("nst"), F.col("detail_url").alias("detail"),
        F.col("event_url").alias("url"))
    geom = F.struct(F.lit("Point").alias("type"),
                    F.array(F.col("longitude"), F.col("latitude"), F.col("depth_km")).alias("coordinates"))
    return F.struct(F.lit("Feature").alias("type"), F.col("event_id").alias("id"),
                    props.alias("properties"), geom.alias("geometry"))


def write_geojson(feed: DataFrame, path: str, doc_key: Column, pretty: bool = False) -> None:
    """Write feed records as FeatureCollection documents, one per line, or
    (``pretty``) as the feed publishes them: one indented document a file.

    ``doc_key`` groups features into documents; callers choose a key with a
    bounded number of features per value so no document grows with the data.
    """
    doc = F.struct(F.lit("FeatureCollection").alias("type"), F.col("features"))
    docs = (feed.groupBy(doc_key.cast("string").alias("doc"))
                .agg(F.collect_list(to_features(feed)).alias("features"))
                .select(F.col("doc"), F.to_json(doc, {"pretty": str(pretty).lower()}).alias("value")))
    if pretty:
        docs.write.mode("overwrite").partitionBy("doc").text(path)
    else:
        docs.select("value").write.mode("overwrite").text(path)
