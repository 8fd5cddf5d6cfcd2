"""Bronze: incremental file source over the landing zone -> append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import versions as vs
from ..sources.landing import landing_glob
from ..sources.schemas import FEED_SCHEMA


def bronze_source(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed records plus ingest metadata.

    Each file is read once (the source checkpoints the paths it has seen);
    ``bronze_load_timestamp`` is one value per micro-batch.
    """
    r = spark.readStream.schema(FEED_SCHEMA).option("mode", "PERMISSIVE")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return (r.json(landing_glob(landing))
             .withColumns({"bronze_load_timestamp": F.current_timestamp(),
                           "source_file": F.col("_metadata.file_path")}))


def start_bronze(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                 trigger: str | None = None, max_files: int | None = None,
                 table: str | None = None) -> StreamingQuery:
    """Start the landing -> Bronze append stream.

    ``trigger=None`` processes what is available and stops (``availableNow``);
    otherwise a processing-time interval such as ``"30 seconds"``.  The sink
    is exactly-once through the checkpoint and the sink's own commit log.
    """
    w = (bronze_source(spark, landing, max_files).writeStream
         .format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    if table:
        return w.option("path", bronze_path).toTable(table)
    return w.start(bronze_path)


def stream_status(spark: SparkSession) -> list[dict]:
    """Active streams with their last progress (small driver metadata)."""
    return [{"id": str(q.id), "name": q.name, "active": q.isActive, "progress": q.lastProgress}
            for q in spark.streams.active]


PROGRESS = "query string, run_id string, batch_id bigint, started_at string, input_rows bigint, state_rows bigint, millis bigint"


def progress_rows(query: StreamingQuery, name: str) -> list[tuple]:
    """What Spark keeps of the query's last batches (``spark.sql.streaming.numRecentProgressUpdates``), a row each."""
    return [(name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, sum(s.numRowsTotal for s in p.stateOperators),
             int(p.durationMs.get("triggerExecution", 0))) for p in query.recentProgress]


def append_progress(spark: SparkSession, query: StreamingQuery, path: str, name: str) -> None:
    """Append the batches of the query that the table at ``path`` does not hold yet.

    To be called as often as the query's recent progress turns over; batches of
    a run that are recorded already are left out.
    """
    rows = spark.createDataFrame(progress_rows(query, name), PROGRESS)
    if vs.exists(spark, path):
        rows = rows.join(read_progress(spark, path), ["query", "run_id", "batch_id"], "left_anti").select(*rows.columns)
    rows.coalesce(1).write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)


def files_per_batch(files: int, batches: int) -> int:
    """Files a micro-batch may take so that ``files`` come in about so many batches."""
    return max(1, -(-files // batches))
