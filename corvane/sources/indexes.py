"""Named vector tables: one Parquet table of keys and vectors a model, switched on or off by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vector_blocks
from .writers import write_vectors


@dataclass
class IndexSet:
    """paths: a table a model; disabled models are passed over. kind is flat (as given, a row a vector) or half (packed blocks of two bytes a value)."""

    paths: dict[str, str]
    disabled: set[str] = field(default_factory=set)
    kind: str = "flat"

    def __post_init__(self):
        if self.kind not in ("flat", "half"):
            raise ValueError(f"unknown kind of index: {self.kind}")

    def enabled(self) -> list[str]:
        return [name for name in self.paths if name not in self.disabled]

    def save(self, name: str, vectors: DataFrame, key: str = "chunk_id", vector: str = "embedding") -> None:
        """Appends; a key's vector is written once if `vectors` holds only what load() lacks."""
        if self.kind == "half":
            vector_blocks.packed(vectors, key, vector, "half").write.mode("append").parquet(self.paths[name])
        else:
            write_vectors(vectors, self.paths[name], key, vector)

    def exists(self, spark: SparkSession, name: str) -> bool:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths[name])
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def checked(self, spark: SparkSession, name: str) -> tuple[DataFrame | None, bool]:
        """The named table and whether it can be read and holds vectors; (None, False) if it is absent or broken."""
        try:
            found = self.load(spark, name)
            return (found, True) if not found.where("embedding is not null").isEmpty() else (found, False)
        except Exception as e:  # whatever the reader raises: this is the check
            print(f"{name}: {e}"[:500])
            return None, False

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        """A row a vector, as stored."""
        rows = spark.read.parquet(self.paths[name])
        return vector_blocks.unpacked(rows) if self.kind == "half" else rows

    def blocks(self, spark: SparkSession, name: str) -> DataFrame:
        """The packed blocks of a half index, for operators.pivots.search."""
        return spark.read.parquet(self.paths[name])

    def keys(self, spark: SparkSession, name: str, key: str = "chunk_id") -> DataFrame:
        """The keys that have a vector; vectors are not read."""
        rows = spark.read.parquet(self.paths[name])
        return vector_blocks.keys_of(rows, key) if self.kind == "half" else rows.select(key)

    def load_all(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.load(spark, name) for name in self.enabled()}
