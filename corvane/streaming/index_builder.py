"""Vector indexes built from a stream of chunk files, batch by batch, with a checkpoint after each.

Each batch's vectors are a folder of their own under the index, named by the batch. A batch that was broken off and is run
again overwrites its folder, so its vectors stand there once. Chunks that an earlier batch has stored are not encoded again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import models
from ..plans import retrieval
from ..sources import vector_blocks


def stored_keys(spark: SparkSession, path: str, before: int | None = None, key: str = "chunk_id") -> DataFrame | None:
    """The keys that the index holds, or that batches before one have stored; None if there are none. No vector is read."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root) or not [s for s in system.listStatus(root) if s.getPath().getName().startswith("batch=") and (before is None or int(s.getPath().getName()[6:]) < before)]:
        return None
    rows = spark.read.parquet(path)
    rows = rows if before is None else rows.where(F.col("batch") < before)
    return vector_blocks.keys_of(rows, key) if "keys" in rows.columns else rows.select(key)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, embedding) of all batches."""
    rows = spark.read.parquet(path)
    return vector_blocks.unpacked(rows) if "keys" in rows.columns else rows.drop("batch")


def build(spark: SparkSession, source: str, schema: T.StructType | str, docs: DataFrame, make: Callable[[], models.Encoder], path: str, checkpoint: str, files: int = 16, kind: str = "flat", report: Callable[[int, int], None] | None = None) -> DataFrame:
    """Encodes all chunk files of the folder `source` that the checkpoint does not know, `files` at a time, and returns the index.

    A run that was broken off goes on with the batch it was at; a later run takes files that have come since. Rows of one
    chunk in a batch count once, and only the texts of its own documents are shuffled for it. kind: flat (a row a vector) or half (packed blocks). report: told the batch and the vectors
    it stored. source, path and checkpoint are folders that all executors share; the same checkpoint belongs to the same index.
    """

    def store(batch: DataFrame, number: int) -> None:
        target, known = f"{path}/batch={number}", stored_keys(spark, path, number)
        own = F.broadcast(batch.select(F.col("doc_id").cast("string").alias("__doc")).distinct())  # of `files` files
        texts = docs.join(own, F.col("doc_id").cast("string") == F.col("__doc"), "left_semi")
        vectors = retrieval.embed(batch.dropDuplicates(["chunk_id"]), texts, make, known)
        out = vector_blocks.packed(vectors, kind=kind) if kind == "half" else vectors
        out.write.mode("overwrite").parquet(target)
        if report:
            done = spark.read.parquet(target)
            report(number, vector_blocks.keys_of(done).count() if kind == "half" else done.count())

    chunks = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    query = chunks.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_index(spark, path)
