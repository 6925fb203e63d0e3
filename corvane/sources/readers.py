"""Sources: Parquet, CSV, JSON and mixed folders as DataFrames, with the roles of their columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import split_csv, split_json


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: str | None = None, tolerant: bool = False, required: Sequence[str] = ()) -> DataFrame:
    """A CSV with a header and quoted line ends, in as many tasks as it has byte ranges. tolerant: all columns as text.

    Short records are padded, long ones cut, bytes that are not UTF-8 dropped; fields may be of any length. schema: columns by
    name, as these types; values that don't fit are null. ValueError if a required column is missing. Without schema or tolerance, types are inferred.
    """
    df = split_csv.read(spark, path)
    if schema:
        wanted = spark.createDataFrame([], schema).schema
        df = df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])
    elif not tolerant:
        df = split_csv.with_types(df)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_documents(spark: SparkSession, path: str, kind: str | None = None, sample: int | None = None) -> DataFrame:
    """(doc_id, title, text) from Parquet, JSON lines, a JSON list or a JSON object of id to text; ids under id or doc_id, texts under text or content.

    kind (parquet, jsonl, json, csv) follows from the suffix if it is not given; ValueError for others.
    """
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "jsonl":
        df = spark.read.json(path)
    elif kind == "csv":
        df = read_csv(spark, path, tolerant=True)
    elif kind == "json":
        df = _json_documents(spark, path)
    else:
        raise ValueError(f"unknown kind of file: {kind}")
    pick = lambda names: F.coalesce(*[F.col(c).cast("string") for c in names if c in df.columns], F.lit(None).cast("string"))
    out = df.select(pick(("doc_id", "id")).alias("doc_id"), F.coalesce(pick(("title",)), F.lit("")).alias("title"), pick(("text", "content")).alias("text"))
    return out.limit(sample) if sample else out


def _json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, title, text) of the members of a list or an object; a file that is one document by its keys is read as such."""
    if not split_json.members(spark, path).where(F.col("key").isin("id", "doc_id", "text", "content")).limit(1).isEmpty():
        return spark.read.json(path, multiLine=True)
    of = lambda name: F.get_json_object("value", f"$.{name}")
    texts = F.coalesce(of("text"), of("content"), F.col("plain"), F.when(F.col("key").isNotNull(), F.col("value")))
    return split_json.members(spark, path).select(F.coalesce("key", of("doc_id"), of("id")).alias("doc_id"), of("title").alias("title"), texts.alias("text"))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """All *.parquet and *.csv files of a folder, by column name; missing columns are null."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().toString() for s in root.getFileSystem(conf).listStatus(root)]
    parts = []
    for kind in ("parquet", "csv"):
        if found := sorted(n for n in names if n.endswith(f".{kind}")):
            parts.append(spark.read.parquet(*found) if kind == "parquet" else split_csv.read(spark, found))
    if not parts:
        raise ValueError(f"no files in {path}")
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p.select([F.col(c).cast(dict(df.dtypes)[c]) if c in df.columns else F.col(c) for c in p.columns]), allowMissingColumns=True)
    return df


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """(position, chunk_id) from a JSON list of ids, or from an object of position to id. The file is read in parts; a list's places are numbered across them."""
    from ..operators.ordering import number_rows

    found = split_json.members(spark, path).select("file", "block", "number", "key", F.coalesce("plain", "value").alias("chunk_id"))
    as_list = number_rows(found.where("key is null"), "position", "file", "block", "number").select(F.col("position").cast("int").alias("position"), "chunk_id")
    return as_list.unionByName(found.where("key is not null").select(F.col("key").cast("int").alias("position"), "chunk_id"))


def child_spans(children: DataFrame) -> DataFrame:
    """(doc_id, spans): the child chunks of each document in order; start_char or child_start, where 0 falls through to the other."""
    pick = lambda a, b: F.coalesce(*[F.nullif(F.col(c), F.lit(0)) for c in (a, b) if c in children.columns], F.lit(0)).cast("int")
    span = F.struct(pick("start_char", "child_start").alias("start"), pick("end_char", "child_end").alias("end"))
    return children.groupBy("doc_id").agg(F.array_sort(F.collect_list(span)).alias("spans"))


#: What files of vector indexes of the common library begin with, flat and inverted ones, by the sign that their kinds share.
INDEX_MAGIC = "Ix|IH|Iw|IB"


def file_kinds(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, kind): json if it begins with { or [ and ends with what closes it, index by a vector index's first bytes, parquet by its mark at both ends, binary under 30 % printable of the first 16 bytes, else text. The scan leaves empty files out.

    Only a file's first and last bytes are looked at after it is read; files of a size that a row cannot hold are out of its reach.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select("path", "length", F.substring("content", 1, 16).alias("head"), F.expr("decode(right(content, 16), 'ISO-8859-1')").alias("tail"))
    codes = F.transform(F.sequence(F.lit(1), F.greatest(F.length("head"), F.lit(1))), lambda i: F.ascii(F.decode(F.substring(F.col("head"), i, F.lit(1)), "ISO-8859-1")))
    printable = F.size(F.filter(codes, lambda c: (c >= 32) & (c < 127))) / F.greatest(F.length("head"), F.lit(1))
    first, last = F.ltrim(F.decode("head", "ISO-8859-1")), F.regexp_replace("tail", r"\s+$", "")
    closed = (first.startswith("{") & last.endswith("}")) | (first.startswith("[") & last.endswith("]"))
    kind = F.when(closed, "json").when(first.rlike(f"^({INDEX_MAGIC})") & (printable < 0.7), "index").when(first.startswith("PAR1") & last.endswith("PAR1"), "parquet").when(printable < 0.3, "binary")
    return files.select("path", "length", kind.otherwise("text").alias("kind"))
