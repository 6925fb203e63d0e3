"""Checks of tables: profiles, nulls, coverage of ids, preprocessing counts, resource samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, non_null, nulls, ratio): one aggregate over all columns, then unpivoted."""
    columns = list(columns or df.columns)
    one = df.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in columns])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null"), (F.col("__n") - F.col(c)).alias("nulls"), (F.col(c) / F.nullif(F.col("__n"), F.lit(0))).alias("ratio")) for c in columns])).alias("x")
    return one.select(cells).select("x.*")


def column_profile(df: DataFrame) -> DataFrame:
    """(column, kind, lowest, highest, mean): of numbers, of text lengths and of list lengths."""
    aggs, cells = [], []
    for i, (c, kind) in enumerate(df.dtypes):
        if kind == "string":
            v, name = F.length(c), "text length"
        elif kind.startswith("array"):
            v, name = F.when(F.col(c).isNotNull(), F.size(c)), "list length"
        elif kind in ("boolean", "binary", "date") or kind.startswith(("map", "struct", "timestamp")):
            continue
        else:
            v, name = F.col(c), "number"
        aggs += [F.min(v).cast("double").alias(f"a{i}"), F.max(v).cast("double").alias(f"b{i}"), F.avg(v).cast("double").alias(f"m{i}")]
        cells.append(F.struct(F.lit(c).alias("column"), F.lit(name).alias("kind"), F.col(f"a{i}").alias("lowest"), F.col(f"b{i}").alias("highest"), F.col(f"m{i}").alias("mean")))
    return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def drop_null_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows without nulls, and one row with the numbers before, after and deleted."""
    whole = None
    for c in df.columns:
        whole = F.col(c).isNotNull() if whole is None else whole & F.col(c).isNotNull()
    counts = df.agg(F.count("*").alias("n_before"), F.count_if(whole).alias("n_after"))
    return df.na.drop("any"), counts.withColumn("n_deleted", F.col("n_before") - F.col("n_after"))


def null_rows(df: DataFrame) -> DataFrame:
    """The rows that hold a null, with the names of their null columns."""
    found = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in df.columns]))
    return df.withColumn("null_columns", found).where(F.size("null_columns") > 0)


def coverage(mapping: DataFrame, chunks: DataFrame, key: str, samples: int = 5) -> DataFrame:
    """One row: how the ids of a mapping cover those of a table: state, missing, extra, and the smallest few of each."""
    m, c = mapping.select(F.col(key).alias("k")).distinct().withColumn("m", F.lit(1)), chunks.select(F.col(key).alias("k")).distinct().withColumn("c", F.lit(1))
    both = m.join(c, "k", "full_outer").where("m is null or c is null")
    missing, extra = F.col("m").isNull(), F.col("c").isNull()
    few = lambda cond: F.coalesce(F.array_join(F.slice(F.array_sort(F.collect_list(F.when(cond & (F.col("r") <= samples), F.col("k")))), 1, samples), ","), F.lit(""))
    from pyspark.sql import Window

    one = both.groupBy(missing.alias("is_missing")).agg(F.count("*").alias("n"))
    firsts = both.withColumn("r", F.row_number().over(Window.partitionBy(F.when(missing, 0).otherwise(1)).orderBy("k"))).where(F.col("r") <= samples)
    out = one.agg(F.coalesce(F.sum(F.when(F.col("is_missing"), F.col("n"))), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.when(~F.col("is_missing"), F.col("n"))), F.lit(0)).alias("extra"))
    shown = firsts.agg(few(missing).alias("missing_samples"), few(extra).alias("extra_samples"))
    state = F.when((F.col("missing") == 0) & (F.col("extra") == 0), "complete").when(F.col("missing") == 0, "over-indexed").when(F.col("extra") == 0, "incomplete").otherwise("mismatch")
    return out.join(shown, F.lit(True)).withColumn("coverage", state)


def id_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The distinct ids of a that b lacks."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def unprocessed(chunks: DataFrame, done: DataFrame, key: str = "chunk_id") -> DataFrame:
    """What is left to do: the existing output is the checkpoint."""
    return chunks.join(done.select(key).distinct(), key, "left_anti")


def source_counts(chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks by source, the part of their id before the first colon."""
    return chunks.groupBy(F.split(F.col(key).cast("string"), ":")[0].alias("source")).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), *[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def preprocess_statistics(docs: DataFrame, text: str = "text", title: str = "title", least_chars: int = 100) -> DataFrame:
    """One row: documents in all, kept, rejected, too short, with a good title."""
    cleaned = docs.select(T.full_text_cleaning(F.col(text)).alias("t"), T.is_good_title(F.col(title)).alias("good"))
    long_enough = F.col("t").isNotNull() & (F.length("t") >= least_chars)
    return cleaned.agg(F.count("*").alias("total"), F.count_if(long_enough).alias("kept"), F.count_if(F.col("t").isNull()).alias("rejected"), F.count_if(F.col("t").isNotNull() & (F.length("t") < least_chars)).alias("short"), F.count_if("good").alias("good_titles"))


def bottleneck(samples: DataFrame, cpu: str = "cpu", gpu: str = "gpu") -> DataFrame:
    """One row from samples of load in percent: means, and what is short: a device over 80 while the other is under 50, both over 80, or neither."""
    one = samples.agg(F.coalesce(F.avg(cpu), F.lit(0.0)).alias("cpu"), F.coalesce(F.avg(gpu), F.lit(0.0)).alias("gpu"))
    kind = F.when((F.col("cpu") > 80) & (F.col("gpu") < 50), "cpu").when((F.col("cpu") < 50) & (F.col("gpu") > 80), "gpu").when((F.col("cpu") > 80) & (F.col("gpu") > 80), "both").otherwise("idle")
    return one.withColumn("bottleneck", kind)


def parent_sizes(chunks: DataFrame) -> DataFrame:
    """One row: smallest, mean and largest parent in characters and in tokens of four."""
    size = F.col("parent_end") - F.col("parent_start")
    one = chunks.agg(F.min(size).cast("long").alias("min_chars"), F.floor(F.avg(size)).alias("mean_chars"), F.max(size).cast("long").alias("max_chars"))
    return one.select("*", *[F.floor(F.col(f"{a}_chars") / 4).alias(f"{a}_tokens") for a in ("min", "mean", "max")])


# Names of text, title and position columns, in order of preference where it matters.
TEXT_NAMES = ("text", "content", "article", "body", "paragraph", "desc", "description", "wiki_text", "page_content")
TITLE_NAMES = ("title", "name", "heading", "subject", "page_title")
START_NAMES, END_NAMES = ("start_char", "child_start"), ("end_char", "child_end")
ID_NAMES, BODY_NAMES = ("id", "doc_id", "document_id"), ("text", "content", "document_text")


def text_columns(columns: Sequence[str]) -> list[str]:
    """Columns named as texts are; else those whose name holds text, then content; else the first three without id or index in their name, or the first three."""
    low = {c: c.lower() for c in columns}
    for found in ([c for c in columns if low[c] in TEXT_NAMES], [c for c in columns if "text" in low[c]], [c for c in columns if "content" in low[c]]):
        if found:
            return found
    return [c for c in columns if "id" not in low[c] and "index" not in low[c]][:3] or list(columns[:3])


def title_and_text(df: DataFrame, as_it_stands: bool = False) -> DataFrame:
    """df with __title, the first non-blank title column, and __text, the non-blank text columns joined by blank lines.

    as_it_stands: blank and null values count as others do: __title is the first title column, and __text is null if a text column is.
    """
    filled = lambda c: F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", F.col(c).cast("string"))
    titles = [c for c in df.columns if c.lower() in TITLE_NAMES]
    texts = [c for c in text_columns(df.columns) if c not in titles]
    if as_it_stands:
        parts = [x for c in texts for x in (F.lit("\n\n"), F.col(c).cast("string"))][1:]
        return df.withColumns({"__title": F.col(titles[0]).cast("string") if titles else F.lit(""), "__text": F.concat(*parts) if parts else F.lit("")})
    return df.withColumns({"__title": F.coalesce(*map(filled, titles), F.lit("")), "__text": F.concat_ws("\n\n", *map(filled, texts))})


def role_column(columns: Sequence[str], candidates: Sequence[str]) -> str:
    """The first candidate that is a column; ValueError if none is."""
    for c in candidates:
        if c in columns:
            return c
    raise ValueError(f"none of {list(candidates)} in {list(columns)}")
