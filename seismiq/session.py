"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on.  They are applied only where the session
# does not already carry a value, so a cluster's own configuration wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "seismiq",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC (all feed times are UTC) and make sure a checkpoint dir exists."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Landing files, exported tables and stream checkpoints are written here
    so that every executor (and a restarted driver) sees them.  Only when the
    setting is absent in local mode (tests) is a private folder created and
    set; on a cluster a missing setting is an error, never a local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="seismiq-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    jsc_dir = spark.sparkContext.getCheckpointDir()
    if not jsc_dir:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unique location under the shared folder."""
    return f"{shared_dir(spark)}/seismiq/{kind}/{uuid.uuid4().hex}"


def scale_settings(input_bytes: int, cores: int, shuffle_fraction: float = 0.5,
                   target_bytes: int = 256 << 20, max_partitions: int = 100_000) -> dict:
    """Scan and shuffle sizing for a run over ``input_bytes`` on ``cores``.

    Scan splits aim at about eight waves of map tasks, each between 128 MiB
    and 1 GiB: Parquet is read in column batches, so a large split costs no
    extra memory, and fewer map tasks mean fewer shuffle blocks.  Shuffle
    partitions start at one per ``target_bytes`` of shuffled data -- the
    input times ``shuffle_fraction`` (the dedup moves whole projected rows;
    aggregations move far less after map-side combining) -- with at least
    two waves of reducers and at most ``max_partitions``, because every
    reducer fetches from every map task (maps x reducers blocks).  Adaptive
    execution then coalesces small partitions and splits skewed ones.
    """
    waves = 8
    split = min(1 << 30, max(128 << 20, -(-input_bytes // (cores * waves))))
    shuffled = int(input_bytes * shuffle_fraction)
    parts = min(max_partitions, max(2 * cores, -(-shuffled // target_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (one file-system metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def apply_scale(spark: SparkSession, path: str, cores: int) -> dict:
    """Size scans and shuffles for the input at ``path`` on ``cores`` cores."""
    conf = scale_settings(input_bytes(spark, path), cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
