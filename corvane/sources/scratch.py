"""Intermediate tables that a plan reads more than once, below the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, removed when the application ends. Only with a local master may that setting be absent."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/corvane-scratch-{os.getuid()}"
    path = f"{base.rstrip('/')}/corvane-{uuid.uuid4().hex}"
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(root)
    return path


def stored(df: DataFrame) -> DataFrame:
    """df, written once and read from there."""
    path = f"{folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_kept: dict[tuple, str] = {}


def kept(spark: SparkSession, name: str, inputs: list[str], make: Callable[[str], object]) -> str:
    """The folder that make(folder) filled, made once an application for a name and the state of its input files: a changed file or a folder that has gone makes it anew.

    For what many queries of a session share, such as an index. The folder goes when the application ends.
    """
    state = []
    for path in inputs:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        state += sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in system.listStatus(p))
    key = (spark.sparkContext.applicationId, name, *state)
    if (there := _kept.get(key)) is not None:
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(there)
        if root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            return there
    path = folder(spark)
    make(path)
    _kept[key] = path
    return path
