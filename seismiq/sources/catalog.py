"""Catalog tables: schemas, overwrite / append sinks, listing.

Tables are Parquet (no table format with a transaction log is assumed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: layer schemas --------------------------------------------
LAYER_SCHEMAS = ["bronze", "silver", "gold"]
# -------------------------------------------------------------------------------


def ensure_schemas(spark: SparkSession, names: list[str] = LAYER_SCHEMAS) -> None:
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {n}")


def save_overwrite(df: DataFrame, table: str, path: str | None = None,
                   partition_by: list[str] | None = None) -> None:
    """Replace a table (data and schema).

    Never point this at a table the plan of ``df`` reads: with Parquet the
    old files would be deleted before they are read.
    """
    w = df.write.mode("overwrite").format("parquet").option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def save_append(df: DataFrame, table: str, path: str | None = None) -> None:
    w = df.write.mode("append").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")
