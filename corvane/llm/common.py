"""What the operators of this subpackage share: shared tables, Arrow batches, shipping code."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one Arrow batch may hold on its way to a Python worker.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096

#: Bytes by which the driver's heap may grow before a finished table is a reason to collect its garbage.
HEAP_GROWTH = 48 << 20

_shipped: set[str] = set()
_heap_after = [0]


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds the Arrow batches of the session and ships this package to its executors, once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp()  # executors fetch the archive from the driver, so it stays until the driver ends
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        where = Path(folder) / f"{root.name}.zip"
        with zipfile.ZipFile(where, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(where))
        _shipped.add(app)
    return spark


def tidy_driver(spark: SparkSession, growth: int = 0) -> None:
    """Collects the driver's garbage, so that the cleaner takes what finished steps left and free memory goes back.

    With growth only if the heap has grown by more since the last time: with many small tasks it would grow to its limit before the JVM itself sees reason to.
    """
    heap = spark.sparkContext._jvm.Runtime.getRuntime()
    if growth and heap.totalMemory() - _heap_after[0] <= growth:
        return
    gc.collect()
    heap.gc()
    trim()
    _heap_after[0] = heap.totalMemory()


class Workspace:
    """Tables that cut lineage, in a folder of their own below spark.checkpoint.dir, which all executors share.

    Only with a local master, as in tests, may that setting be absent; then a local folder is used.
    A lost executor loses none of these tables, so later stages do not go back beyond them. They go when the application ends.
    """

    #: Where a list stands here, new folders are noted in it, for whoever knows when they are spent.
    noted: list[Workspace] | None = None

    def __init__(self, spark: SparkSession, name: str):
        if Workspace.noted is not None:
            Workspace.noted.append(self)
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if spark.sparkContext.master.partition("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = f"file://{tempfile.gettempdir()}/corvane-shared-{os.getuid()}"
        self.spark, self.root = spark, f"{base.rstrip('/')}/corvane-{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.mode("overwrite").option("compression", "snappy")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        root, system = self._path()
        system.deleteOnExit(root)
        tidy_driver(self.spark, HEAP_GROWTH)
        return self.read(name, df.schema)

    def _path(self, name: str = ""):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def remove(self) -> None:
        """Removes the folder and all its tables."""
        root, system = self._path()
        system.delete(root, True)

    def drop(self, *names: str) -> None:
        """Removes tables that no later step reads, lets the cleaner take the shuffle files of finished steps, and gives the driver's free memory back."""
        for name in names:
            path, system = self._path(name)
            system.delete(path, True)
        tidy_driver(self.spark)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs, under names of its own, so that no other column can clash. Null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


#: A key is hot if it holds more than one in so many rows; so no more keys than this are ever hot.
HOT_KEYS = 1000


def attach(rows: DataFrame, facts: DataFrame, key: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with facts, which has one row a key. hot: the keys that hold over one in HOT_KEYS of rows.

    The facts of hot keys, at most HOT_KEYS rows, are broadcast, so that no task gets all rows of one; the others shuffle.
    """
    hot = F.broadcast(hot.select(*key).distinct())
    few = F.broadcast(facts.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_semi").join(few, key, how).unionByName(rows.join(hot, key, "left_anti").join(facts, key, how))


def numbered(docs: DataFrame, ws: Workspace) -> tuple[DataFrame, str]:
    """docs as a written table with one more column that numbers its rows, and that column's name."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    return ws.write(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of "name type, name type", which Spark reads as well."""
    return pa.schema([pa.field(name, _ARROW[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def record(schema: pa.Schema, n: int, /, **columns) -> pa.RecordBatch:
    """A record batch of n rows; columns that are not given are null."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def in_fold(id_column: Column, folds: int) -> Column:
    """The remainder of crc32(id as text), in the JVM. A null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


_PACKED = pa.schema([("run", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("texts", pa.binary())])
PACKED = "run long, doc_ids array<long>, sizes array<int>, texts binary"


def pack_runs(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = BATCH_BYTES) -> DataFrame:
    """Documents as a table of runs: about run_bytes of whole texts, compressed, with their ids. A run is read again and again under the same number."""

    @trimmed
    def pack(batches):
        import zstandard
        from pyspark import TaskContext

        run, ids, texts, held = TaskContext.get().partitionId() << 20, [], [], 0
        squeeze = zstandard.ZstdCompressor(level=3)

        def row():
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([run], [ids], [[len(t) for t in texts]], [squeeze.compress(b"".join(texts))]), _PACKED)], schema=_PACKED)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held >= run_bytes or len(ids) >= 1 << 19:
                    yield row()
                    run, ids, texts, held = run + 1, [], [], 0
        if ids:
            yield row()

    return ws.write(id_and_text(docs, id_col, text_col).mapInArrow(pack, PACKED), "packed")


def unpack(sizes: list[int], texts: bytes) -> list[bytes]:
    """The texts of a run."""
    import zstandard

    whole, at, out = zstandard.ZstdDecompressor().decompress(texts) if sum(sizes) else b"", 0, []
    for n in sizes:
        out.append(whole[at : at + n])
        at += n
    return out


def trimmed(task):
    """A task over batches that gives its free memory back when it ends: idle workers stay, and count for their executor."""

    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            trim()

    return run


def trim() -> None:
    """Gives memory that Arrow and the C library hold free back to the system, so that a worker's size follows what it needs now."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mixed(h):
    """Spreads the bits of 64-bit integers (the finaliser of splitmix64)."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
