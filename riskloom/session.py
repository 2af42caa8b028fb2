"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its time zone.

    Partition counts are left to the cluster: adaptive execution coalesces the
    configured ``spark.sql.shuffle.partitions`` and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is only ever chosen in local mode, where the one machine
    is the cluster.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    chosen = tempfile.mkdtemp(prefix="riskloom-")
    context.setCheckpointDir(chosen)
    return chosen


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage before a table is used many times: later stages prune columns
    from the written files, and a lost executor costs a re-read, not a recompute.
    """
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Even out rows by the hash of a unique key before many passes over them.

    No partition count is named, so adaptive execution sizes the partitions: few for
    little data, up to ``spark.sql.shuffle.partitions`` for much.
    """
    return df.repartition(key)
