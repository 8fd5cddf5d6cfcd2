"""Versioned tables: data folders that are never changed, and manifests that name them.

A version is published when its manifest has its name, which takes one rename
of one small file.  Readers take the latest manifest, so they see one version
whatever a writer is doing; what was written for a version that was never
published is not read, and is written again by a replay.  A manifest is a JSON
list with an entry for each folder in use (a date partition, an export run, a
schema): metadata whose size follows the calendar, not the events.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The file system and Hadoop path of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/manifests/{version}.json"


def is_published(spark: SparkSession, root: str, version: int) -> bool:
    return exists(spark, _manifest_path(root, version))


def published(spark: SparkSession, root: str) -> list[int]:
    """The published versions that are kept, oldest first."""
    fs, p = hadoop_path(spark, f"{root.rstrip('/')}/manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def latest(spark: SparkSession, root: str) -> int | None:
    """The version published last; None before the first."""
    return max(published(spark, root), default=None)


def manifest(spark: SparkSession, root: str, version: int | None) -> list[list]:
    """The entries of a version; none before the first."""
    if version is None:
        return []
    fs, p = hadoop_path(spark, _manifest_path(root, version))
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of any that is there."""
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def publish(spark: SparkSession, root: str, version: int, entries: list) -> None:
    """Write the manifest under a name that no reader looks at, then give it its own."""
    target = _manifest_path(root, version)
    write_text(spark, f"{target}.staged", json.dumps(entries))
    fs, p = hadoop_path(spark, target)
    if not fs.rename(hadoop_path(spark, f"{target}.staged")[1], p):
        raise OSError(f"version {version} of {root} could not be published")


def retire(spark: SparkSession, root: str, version: int) -> None:
    """Delete the manifest of a version."""
    delete(spark, _manifest_path(root, version))
