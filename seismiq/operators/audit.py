"""Layer row counts and table status, each in a single Spark job."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def layer_audit(layers: dict[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of one global count per layer -> (layer, rows).

    Built as one plan, so a single action counts every layer.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
             for name, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)


_STATUS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])


ERROR_CHARS = 80


def table_status(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Row count per catalogued table; a table that cannot be read gets the
    engine's own error text (first 80 characters).  Existing tables are
    counted in one union job."""
    parts, missing = [], []
    for name in tables:
        try:
            rows = spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
        except AnalysisException as e:
            missing.append((name, "missing", None, str(e).replace("\n", " ")[:ERROR_CHARS]))
        else:
            parts.append(rows.select(F.lit(name).alias("table_name"), F.lit("ok").alias("status"), "rows",
                                     F.lit(None).cast("string").alias("error")))
    if missing:
        parts.append(spark.createDataFrame(missing, _STATUS_SCHEMA))
    if not parts:
        return spark.createDataFrame([], _STATUS_SCHEMA)
    return reduce(DataFrame.unionByName, parts)
