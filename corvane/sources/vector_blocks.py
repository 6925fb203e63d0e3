"""Vectors in packed blocks: the keys of up to some thousand vectors beside one binary column that is read straight into a matrix.

Values take two bytes (half) or four (flat). Each block also holds its centre, the mean of its vectors, and its radius, the
largest distance from it, both of the values as stored, so that a search can tell what the block can hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded

#: Bytes of a value, by kind.
KINDS = {"half": np.float16, "flat": np.float32}
ROWS = 1024


def block_schema(key_type: str) -> str:
    return f"dim int, kind string, keys array<{key_type}>, centre binary, radius double, vectors binary"


def matrix(dim: int, kind: str, data: bytes) -> np.ndarray:
    return np.frombuffer(data, KINDS[kind]).reshape(-1, dim).astype(np.float64)


def packed(vectors: DataFrame, key: str = "chunk_id", vector: str = "embedding", kind: str = "flat", rows: int = ROWS, group: str | None = None) -> DataFrame:
    """Blocks of up to `rows` vectors of one width, and of one value of `group`, as they come. Null and empty vectors are left out, null values count as 0."""
    key_type, value = dict(vectors.dtypes)[key], KINDS[kind]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        held: list[np.ndarray] = []
        now, field = None, None

        def block() -> pa.RecordBatch:
            m = np.stack(held).astype(value)
            exact = m.astype(np.float64)
            centre = exact.mean(axis=0)
            radius = float(np.sqrt(((exact - centre) ** 2).sum(axis=1)).max()) * (1 + 1e-9)
            return pa.RecordBatch.from_arrays([pa.array([m.shape[1]], pa.int32()), pa.array([kind]), pa.array([keys], pa.list_(field)), pa.array([centre.tobytes()]), pa.array([radius]), pa.array([m.tobytes()])], names=["dim", "kind", "keys", "centre", "radius", "vectors"])

        for batch in batches:
            field = batch.schema.field(0).type
            for key_, v, g in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                x = np.nan_to_num(v.values.to_numpy(zero_copy_only=False).astype(np.float64), posinf=np.inf, neginf=-np.inf)
                if held and (now != (len(x), g) or len(held) >= rows):
                    yield block()
                    keys, held = [], []
                now = len(x), g
                keys.append(key_)
                held.append(x)
        if held:
            yield block()

    chosen = vectors.select(F.col(key).alias("k"), F.col(vector).cast("array<float>").alias("v"), (F.col(group) if group else F.lit(0)).cast("long").alias("g")).where("size(v) > 0")
    bounded(vectors.sparkSession)
    return chosen.mapInArrow(pack, block_schema(key_type))


def unpacked(blocks: DataFrame, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """One row a vector, with values as stored."""
    key_type = dict(blocks.dtypes)["keys"][len("array<") : -1]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, kind, keys, data in zip(*(batch.column(c).to_pylist() for c in ("dim", "kind", "keys", "vectors"))):
                values = pa.array(matrix(dim, kind, data).astype(np.float32).ravel())
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, dim), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field("keys").type.value_type), rows], names=["k", "v"])

    bounded(blocks.sparkSession)
    return blocks.select("dim", "kind", "keys", "vectors").mapInArrow(unpack, f"k {key_type}, v array<float>").toDF(key, vector)


def keys_of(blocks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The keys alone; no vector is read."""
    return blocks.select(F.explode("keys").alias(key))
