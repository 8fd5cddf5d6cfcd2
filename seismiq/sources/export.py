"""Warehouse export: upper-case column names, overwrite/append, row counts.

Rows are written by the executors straight to the target (Parquet folder or
a JDBC table); nothing is gathered on the driver.  The exported row count is
collected with ``observe`` during the write, so the data is not read twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import versions as vs


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def target_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table.upper()}"


def export(df: DataFrame, root: str, table: str, mode: str = "overwrite",
           jdbc: dict | None = None) -> dict:
    """Export ``df`` as ``table`` under ``root`` (or to JDBC when ``jdbc`` holds
    url/user/password/driver options).  Returns ``{table, mode, rows, columns}``.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    obs = Observation(f"export_{table}")
    out = upper_columns(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    if jdbc:
        (out.write.mode(mode).format("jdbc").options(**jdbc)
            .option("dbtable", table.upper()).save())
    else:
        out.write.mode(mode).parquet(target_path(root, table))
    return {"table_name": table.upper(), "mode": mode,
            "rows": int(obs.get["rows"]), "columns": len(df.columns)}


def verify_exports(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """Row count of each exported table, read back from the target (one job)."""
    parts = [spark.read.parquet(target_path(root, t)).agg(F.count(F.lit(1)).alias("ROWS"))
             .select(F.lit(t.upper()).alias("TABLE_NAME"), "ROWS") for t in tables]
    return reduce(DataFrame.unionByName, parts)


def export_validation(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """Strongest (severity, region) pairs in the exported Gold table."""
    g = spark.read.parquet(target_path(root, "GOLD_INSIGHTS"))
    return (g.groupBy("SEVERITY", "REGION")
             .agg(F.count(F.lit(1)).alias("EVENTS"), F.max("MAX_MAGNITUDE").alias("MAX_MAG"))
             .orderBy(F.col("MAX_MAG").desc_nulls_last(), "SEVERITY", "REGION")
             .limit(n))


# ---- reconciled export -------------------------------------------------------

RUNS = "RUN_ID string, SOURCE_ROWS bigint, TARGET_ROWS bigint"


class ExportMismatch(RuntimeError):
    """The staged rows are not as many as the source's: nothing was published."""


def _runs(spark: SparkSession, target: str) -> list[list]:
    """(run id, source rows, target rows) of each published run."""
    return vs.manifest(spark, target, vs.latest(spark, target))


def _run_path(target: str, run_id: str) -> str:
    return f"{target}/runs/run={run_id}"


def export_reconciled(df: DataFrame, root: str, table: str, run_id: str, mode: str = "append") -> DataFrame:
    """Stage the rows of a run, compare the counts of source and target, publish if they are equal.

    The source is counted while it is written, the target by reading the staged
    files back.  Readers of the table (``read_export``) see a run from the moment
    its manifest is complete.  ``overwrite`` makes the run the whole table.  A
    run id that is published already adds nothing, so a repeated call after a
    lost answer is harmless.  Returns the table's manifest (a row for each run).
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    spark, target = df.sparkSession, target_path(root, table)
    held = _runs(spark, target)
    if run_id not in [h[0] for h in held]:
        counted = Observation(f"export_{table}_{run_id}")
        upper_columns(df).observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(_run_path(target, run_id))
        source = int(counted.get["rows"])
        staged = spark.read.parquet(_run_path(target, run_id)).count()
        if staged != source:
            raise ExportMismatch(f"{table}, run {run_id}: {source} rows of the source, {staged} in the target")
        last = vs.latest(spark, target)
        vs.publish(spark, target, 0 if last is None else last + 1, [*(held if mode == "append" else []), [run_id, source, staged]])
    return export_runs(spark, root, table)


def export_runs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The published runs of a table with both counts and whether they agree."""
    return spark.createDataFrame([tuple(r) for r in _runs(spark, target_path(root, table))], RUNS).select(
        F.lit(table.upper()).alias("TABLE_NAME"), "RUN_ID", "SOURCE_ROWS", "TARGET_ROWS", (F.col("SOURCE_ROWS") == F.col("TARGET_ROWS")).alias("EQUAL"))


def read_export(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of the published runs."""
    target = target_path(root, table)
    return spark.read.parquet(*[_run_path(target, r[0]) for r in _runs(spark, target)])
