"""Sinks: Parquet, CSV and JSON, and output names."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """With a header; single: one file, for results small enough for one task."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, single: bool = False) -> None:
    """One object a line; single: one file, for results small enough for one task."""
    (df.coalesce(1) if single else df).write.mode("overwrite").json(path)


def write_vectors(df: DataFrame, path: str, key: str = "chunk_id", vector: str = "embedding") -> None:
    """Keys and vectors in one table: no positions, no side file."""
    df.select(key, vector).write.mode("append").parquet(path)


def without_null_name(path: str) -> str:
    """The default name beside a table for its rows without nulls."""
    folder, _, name = path.rpartition("/")
    stem, dot, suffix = name.rpartition(".")
    out = f"{stem}_without_null.{suffix}" if dot else f"{name}_without_null"
    return f"{folder}/{out}" if folder else out


def write_lines(lines: DataFrame, path: str, n: int = 1, opens: Sequence[str] = (), closes: Sequence[str] = ()) -> None:
    """The one column of `lines` as n text files, each written by a task of its own between the lines `opens` and `closes`; with n = 1 in their order."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = lambda texts: pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], names=["value"])
        yield frame(opens)
        yield from (pa.RecordBatch.from_arrays([b.column(0)], names=["value"]) for b in batches)
        yield frame(closes)

    spark = lines.sparkSession
    bounded(spark)
    rows = lines.select(F.col(lines.columns[0]).cast("binary").alias("value"))
    dealt = rows.coalesce(1) if n == 1 else rows.repartition(n)
    if n == 1:  # a table without rows may have no task, but its file has its frame
        dealt = spark.createDataFrame([], "value binary").repartition(1).union(dealt).coalesce(1)
    dealt.mapInArrow(framed, "value binary").select(F.col("value").cast("string").alias("value")).write.text(path)
