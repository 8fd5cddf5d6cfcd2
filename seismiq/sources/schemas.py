"""Fixed schemas of the feed, the raw GeoJSON document and the layer tables."""

from pyspark.sql import types as T

# ---- fixed values: names, types and order of the feed's and tables' columns -

# Source / Bronze record: 25 nullable columns (feed contract).
FEED_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("magnitude", T.DoubleType()),
    T.StructField("magnitude_type", T.StringType()),
    T.StructField("depth_km", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("place", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time_epoch_ms", T.LongType()),
    T.StructField("event_time_utc", T.StringType()),
    T.StructField("alert_level", T.StringType()),
    T.StructField("tsunami_flag", T.BooleanType()),
    T.StructField("significance", T.IntegerType()),
    T.StructField("felt_reports", T.IntegerType()),
    T.StructField("cdi", T.DoubleType()),
    T.StructField("mmi", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("network", T.StringType()),
    T.StructField("gap_deg", T.DoubleType()),
    T.StructField("rms", T.DoubleType()),
    T.StructField("nst", T.IntegerType()),
    T.StructField("detail_url", T.StringType()),
    T.StructField("event_url", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.StringType()),
])

FEED_COLUMNS = [f.name for f in FEED_SCHEMA.fields]

# Raw GeoJSON FeatureCollection as published by the feed.
_PROPS = T.StructType([
    T.StructField("mag", T.DoubleType()),
    T.StructField("magType", T.StringType()),
    T.StructField("place", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("alert", T.StringType()),
    T.StructField("tsunami", T.IntegerType()),
    T.StructField("sig", T.IntegerType()),
    T.StructField("felt", T.IntegerType()),
    T.StructField("cdi", T.DoubleType()),
    T.StructField("mmi", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("net", T.StringType()),
    T.StructField("gap", T.DoubleType()),
    T.StructField("rms", T.DoubleType()),
    T.StructField("nst", T.IntegerType()),
    T.StructField("detail", T.StringType()),
    T.StructField("url", T.StringType()),
])

GEOJSON_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("properties", _PROPS),
        T.StructField("geometry", T.StructType([
            T.StructField("coordinates", T.ArrayType(T.DoubleType())),
        ])),
    ]))),
])

# Silver projection, in table order (28 columns).
SILVER_COLUMNS = [
    "event_id", "source", "event_timestamp", "event_time_utc",
    "magnitude", "magnitude_type", "severity",
    "depth_km", "depth_category",
    "latitude", "longitude", "place", "region",
    "alert_level", "tsunami_flag", "significance",
    "felt_reports", "cdi", "mmi",
    "status", "network", "gap_deg", "rms", "nst",
    "detail_url", "event_url",
    "ingestion_timestamp_utc", "silver_load_timestamp",
]

# Classifier feature vector, fixed order.
FEATURE_COLUMNS = [
    "magnitude", "depth_km", "latitude", "longitude",
    "significance", "felt_reports", "cdi", "mmi",
    "gap_deg", "rms", "nst", "tsunami_flag",
]
# -----------------------------------------------------------------------------
