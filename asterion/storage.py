"""Shared-storage locations and committed snapshots.

A snapshot is a table written once into a new version directory. Spark's own
``_SUCCESS`` marker commits it: a version without the marker does not exist for
readers, so a writer lost half way leaves nothing behind that could be read.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables and stream checkpoints."""
    dir = spark.conf.get("spark.checkpoint.dir", None)
    if not dir:
        raise ValueError("spark.checkpoint.dir is not set; name a folder all executors can reach")
    return dir.rstrip("/")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Committed versions of a snapshot, oldest first. Only directory names are listed."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v="):
            done, _ = _fs(spark, f"{path}/{name}/_SUCCESS")
            if fs.exists(done):
                out.append((int(name[2:].split("-")[0]), f"{path}/{name}"))
    return sorted(out)


def latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed version, or None."""
    v = versions(spark, path)
    return spark.read.parquet(v[-1][1]) if v else None


def write_version(df: DataFrame, path: str, version: int | None = None,
                  partition_by: list[str] | None = None) -> str:
    """Write a new version and return its directory.

    With a version number of its own (a stream's batch id) a retry replaces just
    that version; without one every call makes a fresh version.
    """
    if version is None:
        target = f"{path}/v={time.time_ns()}-{uuid.uuid4().hex[:8]}"
    else:
        target = f"{path}/v={version}"
    writer = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; none is fine."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def retain(spark: SparkSession, path: str, newest: int) -> None:
    """Remove all but the newest committed versions of a snapshot."""
    for _, p in versions(spark, path)[:-newest]:
        remove(spark, p)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    This cuts the lineage so that a lost executor costs no recomputation, and gives
    the optimiser the table's true size: a small one is broadcast by Spark's own
    check, and the large table it meets is then filtered where it lies.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}"
    return df.sparkSession.read.parquet(write_version(df, path))


def discard(df: DataFrame) -> None:
    """Delete a table that ``settle`` returned; no plan that reads it may run afterwards."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def write_snapshot(df: DataFrame, path: str, *, max_age_seconds: float | None = None,
                   partition_by: list[str] | None = None) -> DataFrame:
    """Materialise a derived table, reusing a committed version young enough."""
    spark = df.sparkSession
    if max_age_seconds is not None:
        v = versions(spark, path)
        if v and time.time_ns() - v[-1][0] <= max_age_seconds * 1e9:
            return spark.read.parquet(v[-1][1])
    return spark.read.parquet(write_version(df, path, partition_by=partition_by))
