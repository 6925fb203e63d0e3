"""Vector functions on arrays: pooling, norms and products, with higher-order functions or Arrow blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.batches import bounded


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def inner(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(_doubles(x), _doubles(y), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def norm(x: Column) -> Column:
    return F.sqrt(inner(x, x))


def l2_normalize(x: Column) -> Column:
    """Divided by its length, which counts as 1e-12 at least."""
    return F.transform(_doubles(x), lambda v: v / F.greatest(norm(x), F.lit(1e-12)))


def cosine(x: Column, y: Column) -> Column:
    return inner(x, y) / F.greatest(norm(x) * norm(y), F.lit(1e-12))


def mean_pool(vectors: Column, mask: Column) -> Column:
    """The mean of the vectors whose mask is 1; their number counts as 1e-9 at least."""
    n = F.greatest(F.aggregate(mask, F.lit(0.0), lambda s, m: s + m), F.lit(1e-9))
    weighted = F.zip_with(vectors, mask, lambda v, m: F.transform(_doubles(v), lambda a: a * m))
    zero = F.transform(_doubles(F.element_at(vectors, 1)), lambda a: a * 0.0)
    total = F.aggregate(weighted, zero, lambda s, v: F.zip_with(s, v, lambda a, b: a + b))
    return F.transform(total, lambda a: a / n)


def is_vector(v: Column, dim: int) -> Column:
    """Not null, and of the index's dimension."""
    return F.coalesce(F.size(v) == dim, F.lit(False))


def to_half(v: Column) -> Column:
    """Rounded to half precision, as a quantised index stores it."""
    bounded()

    @F.pandas_udf("array<float>")
    def rounded(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else np.asarray(x, np.float16).astype(np.float32))

    return rounded(v)
