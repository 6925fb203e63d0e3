"""CSV files in parts: where records begin is found from the parity of quotes, so that one file feeds many tasks.

Spark deals a file's lines out by byte ranges. A line end ends a record if the quotes before it, counted from the file's
beginning, are even in number. A first scan counts each range's quotes; prefix sums of these tell which ranges begin inside
quotes, and with that each range finds its own record ends. As the standard form asks, quotes within a field stand doubled
in a quoted field.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_ranges import parts_of, records


def begin_inside(rows: DataFrame) -> set[tuple[str, int]]:
    """The byte ranges that begin inside quotes. One small row a range, by prefix sums within each file."""
    text = F.col("value").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    counts = rows.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return {(r["file"], r["block"]) for r in counts.withColumn("before", before).where("before % 2 = 1").select("file", "block").collect()}


def line_ends(inside: bool):
    """Whether a record ends with each line of a range that begins inside quotes or not."""
    odd = int(inside)

    def ends(values: pa.Array) -> np.ndarray:
        nonlocal odd
        state = (odd + np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False))) & 1
        odd = int(state[-1]) if len(state) else odd
        return state == 0

    return ends


def _fields(texts: Iterable[str]) -> Iterator[list[str | None]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(texts, quoting=csv.QUOTE_NOTNULL)


def parsed(records: Iterable[bytes], width: int) -> list[list[str | None]]:
    """Columns of the records' fields. Bytes that are not UTF-8 are dropped, short records padded, long ones cut, blank lines left out. An unquoted empty field is null."""
    texts = [t for t in (r.decode("utf-8", "ignore").removesuffix("\r") for r in records) if t]
    try:
        rows = list(_fields(texts))
    except csv.Error:  # carriage returns outside quotes end records too
        rows = [r for r in _fields(x for t in texts for x in re.split(r"(?<=\r)", t)) if r]
    return [[r[i] if i < len(r) else None for r in rows] for i in range(width)]


def header_of(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The field names of the first file."""
    files = sorted(spark.read.text(path).inputFiles())
    for file in files:
        first, n = spark.read.option("lineSep", "\n").text(file), 1
        while True:
            found = b"\n".join(bytes(r["value"]) for r in first.select(F.col("value").cast("binary").alias("value")).take(n))
            if found.count(b'"') % 2 == 0 or n > 1 << 16:
                break
            n *= 2
        if names := next(_fields(io.StringIO(found.decode("utf-8", "ignore").lstrip("\ufeff"), newline="")), []):
            return [n if n is not None else f"_c{i}" for i, n in enumerate(names)]
    return []


def read(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All records of CSV files with a header as columns of text, in as many tasks as the files have byte ranges.

    The files have the columns of the first one in the same order. The scans: quotes are counted once (now), fragments and
    records are taken when the result is. The driver holds the ranges that begin inside quotes. A record is held whole, so
    an unclosed quote makes one record of all that follows in its file.
    """
    names = header_of(spark, path)
    if not names:
        return spark.createDataFrame([], "value string").drop("value")
    parts = parts_of(spark, path, "\n")
    sent = spark.sparkContext.broadcast(begin_inside(parts))
    schema = pa.schema([(f"c{i}", pa.string()) for i in range(len(names))])

    def begin(file, block):
        inside = (file, block) in sent.value
        return line_ends(inside), inside

    def parse(file, block, number, first, found):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in parsed(found[1:] if first else found, len(names))], schema=schema)

    return records(parts, begin, b"\n", parse, ", ".join(f"c{i} string" for i in range(len(names)))).toDF(*names)


def with_types(df: DataFrame) -> DataFrame:
    """Columns of text as the narrowest of int, bigint, double, timestamp and boolean that all their values are; else as they are."""
    kinds = ("int", "bigint", "double", "timestamp", "boolean")
    fits = [F.min(F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").try_cast(k).isNotNull())).alias(f"{i}_{k}") for i, c in enumerate(df.columns) for k in kinds]
    found = df.agg(*fits).first() if df.columns else {}
    pick = lambda i: next((k for k in kinds if found[f"{i}_{k}"]), "string")
    return df.select(*[F.col(f"`{c}`").cast(pick(i)).alias(c) for i, c in enumerate(df.columns)])
