"""BM25: index tables, scores over postings, and rescoring of candidates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.batches import bounded
from ..sources.scratch import stored

K1, B = 1.5, 0.75
#: Pairs of query and token that are broadcast at a time, some 10 MB, and tokens that are counted at a time.
ASKED, COUNTED = 1 << 17, 1 << 20


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def tokenize(texts: DataFrame, key: str, text: str, tokens=word_tokens) -> DataFrame:
    """(key, tokens); null texts have none but are counted."""
    return texts.select(F.col(key).alias("chunk_id"), tokens(F.col(text)).alias("tokens"))


@dataclass
class Bm25Index:
    """lengths (chunk_id, chunk_len), postings (token, chunk_id, tf), idf (token, df, idf) and one row of metadata."""

    lengths: DataFrame
    postings: DataFrame
    idf: DataFrame
    metadata: DataFrame


def summary(lengths: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """One row: average length, parameters, number of texts."""
    return lengths.agg(F.coalesce(F.avg("chunk_len"), F.lit(0.0)).alias("avgdl"), F.lit(k1).alias("k1"), F.lit(b).alias("b"), F.count("*").alias("num_docs"))


def weights(postings: DataFrame, metadata: DataFrame) -> DataFrame:
    """(token, df, idf): document frequency follows from the postings."""
    df = postings.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log((F.col("num_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf")
    return df.join(F.broadcast(metadata.select("num_docs")), F.lit(True)).select("token", "df", idf)  # one row


def build_index(tokenized: DataFrame, k1: float = K1, b: float = B) -> Bm25Index:
    """Partial counts per (chunk, token) come before the shuffle. Of unstored texts, each table used tokenises them again: write_index does so once."""
    lengths = tokenized.select("chunk_id", F.size("tokens").cast("long").alias("chunk_len"))
    metadata = summary(lengths, k1, b)
    postings = tokenized.select("chunk_id", F.explode("tokens").alias("token")).groupBy("token", "chunk_id").agg(F.count("*").alias("tf"))
    return Bm25Index(lengths, postings, weights(postings, metadata), metadata)


def counted(tokenized: DataFrame) -> DataFrame:
    """(token, chunk_id, tf) of each row by itself, without a shuffle: rows of one key have postings of their own."""
    kind = dict(tokenized.dtypes)["chunk_id"]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + COUNTED, "right")))
                ids, lists = batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low)
                coded = lists.flatten().dictionary_encode()
                width = max(1, len(coded.dictionary))
                cells, n = np.unique(pc.list_parent_indices(lists).to_numpy().astype(np.int64) * width + coded.indices.to_numpy(), return_counts=True)
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(cells % width)), ids.take(pa.array(cells // width)), pa.array(n.astype(np.int64))], names=["token", "chunk_id", "tf"])
                low = high

    bounded(tokenized.sparkSession)
    return tokenized.select("chunk_id", "tokens").mapInArrow(count, f"token string, chunk_id {kind}, tf long")


def write_index(tokenized: DataFrame, path: str, k1: float = K1, b: float = B) -> Bm25Index:
    """The index of tokenized texts as tables below path, each made from stored ones, so that no text is tokenised twice; returned as stored.

    Postings are counted row by row, dealt once, by ranges of (token, chunk_id), added up there and sorted, so a lookup reads
    few row groups and a frequent token spreads over as many files as it fills.
    """
    spark, n = tokenized.sparkSession, int(tokenized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokenized.write.mode("overwrite").parquet(f"{path}/tokenized_chunks")
    texts = spark.read.parquet(f"{path}/tokenized_chunks")
    build_index(texts, k1, b).lengths.write.mode("overwrite").parquet(f"{path}/chunk_len")
    dealt = counted(texts).repartitionByRange(n, "token", "chunk_id").groupBy("token", "chunk_id").agg(F.sum("tf").alias("tf"))
    dealt.sortWithinPartitions("token", "chunk_id").write.mode("overwrite").parquet(f"{path}/inverted_index")
    lengths, postings = spark.read.parquet(f"{path}/chunk_len"), spark.read.parquet(f"{path}/inverted_index")
    metadata = summary(lengths, k1, b)
    metadata.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
    weights(postings, spark.read.parquet(f"{path}/metadata")).repartitionByRange(n, "token").sortWithinPartitions("token").write.mode("overwrite").parquet(f"{path}/idf_table")
    return read_index(spark, path)


def read_index(spark, path: str) -> Bm25Index:
    """The stored k1 and b hold, not the caller's."""
    return Bm25Index(*(spark.read.parquet(f"{path}/{t}") for t in ("chunk_len", "inverted_index", "idf_table", "metadata")))


def lookup(index: Bm25Index, token: str) -> DataFrame:
    """The postings of one token; the filter reaches the scan."""
    return index.postings.where(F.col("token") == token)


def normalize_postings(flat: DataFrame) -> DataFrame:
    """(token, chunk_id) from rows of (token, comma-joined ids)."""
    return flat.select("token", F.explode(F.split("doc_indices", ",")).alias("chunk_id"))


def flatten_postings(postings: DataFrame, block: int = 100_000) -> DataFrame:
    """(token, block, comma-joined ids in order), the stored form of older indexes. A token's list is cut by hash into blocks of about `block` ids, so none is unbounded."""
    blocks = postings.groupBy("token").agg(F.ceil(F.count("*") / block).alias("__blocks")).where("__blocks > 1")
    dealt = postings.join(blocks, "token", "left").withColumn("block", F.coalesce(F.expr("pmod(xxhash64(chunk_id), __blocks)"), F.lit(0)).cast("int"))
    return dealt.groupBy("token", "block").agg(F.array_join(F.array_sort(F.collect_list(F.col("chunk_id").cast("string"))), ",").alias("doc_indices"))


def whole_lists(postings: DataFrame) -> DataFrame:
    """(token, comma-joined ids in order), one row a token. Ids are dealt and sorted by ranges of (token, id) and joined batch by batch, so that only strings of many ids meet for a token."""

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, run = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            token, ids = batch.column(0), batch.column(1)
            starts = np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(token.slice(1), token.slice(0, len(token) - 1)).to_numpy(zero_copy_only=False))])
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(token)), pa.int32()), ids)
            place = lambda n: pa.array(np.full(len(starts), n), pa.int64())
            yield pa.RecordBatch.from_arrays([token.take(pa.array(starts)), place(part), place(run), pc.binary_join(lists, ",")], names=["token", "part", "run", "ids"])
            run += 1

    n = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounded(postings.sparkSession)
    dealt = postings.select("token", F.col("chunk_id").cast("string").alias("chunk_id")).repartitionByRange(n, "token", "chunk_id").sortWithinPartitions("token", "chunk_id")
    pieces = dealt.mapInArrow(join, "token string, part long, run long, ids string").groupBy("token").agg(F.array_sort(F.collect_list(F.struct("part", "run", "ids"))).alias("pieces"))
    return pieces.select("token", F.array_join("pieces.ids", ",").alias("doc_indices"))


def asked_in_groups(queries: DataFrame, idf: DataFrame, most: int = ASKED) -> list[DataFrame]:
    """(query_id, token, qtf, idf) of the queries' known tokens as a stored table, in groups of whole queries with about `most` rows, each small enough to broadcast."""
    q = queries.select("query_id", F.explode("tokens").alias("token")).groupBy("query_id", "token").agg(F.count("*").alias("qtf"))
    asked = stored(q.join(idf.select("token", "idf"), "token").select("query_id", "token", "qtf", "idf"))
    n = -(-asked.count() // most)
    return [asked] if n <= 1 else [asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i) for i in range(n)]


def scores(index: Bm25Index, queries: DataFrame, distinct: bool = True, candidates: DataFrame | None = None) -> DataFrame:
    """(query_id, chunk_id, score) of chunks that share a token with the query (query_id, tokens).

    distinct: each token of the query counts once; else as often as it stands there. candidates (query_id, chunk_id):
    only these are scored. Queries go in groups whose tokens are broadcast. Of the postings, those of asked tokens are dealt by
    chunk, once and before any query meets them, and a chunk's hits are added up where they arise; candidates meet
    their chunk's postings before tokens are compared. So what is shuffled follows the postings, not the hits.
    """
    return reduce(DataFrame.unionByName, [_scored(index, asked, distinct, candidates) for asked in asked_in_groups(queries, index.idf)])


def _scored(index: Bm25Index, asked: DataFrame, distinct: bool, candidates: DataFrame | None) -> DataFrame:
    """scores for queries whose (query_id, token, qtf, idf) are broadcast."""
    postings = index.postings.join(F.broadcast(asked.select("token").distinct()), "token", "left_semi")
    if candidates is not None:
        postings = postings.join(candidates.select("query_id", "chunk_id").distinct(), "chunk_id")
    else:
        postings = postings.repartition("chunk_id")
    rows = postings.join(index.lengths, "chunk_id")
    hits = rows.join(F.broadcast(asked), ["token"] if candidates is None else ["token", "query_id"]).join(F.broadcast(index.metadata), F.lit(True))  # one row
    tf = F.col("tf").cast("double")
    part = F.col("idf") * tf * (F.col("k1") + 1) / (tf + F.col("k1") * (1 - F.col("b") + F.col("b") * F.col("chunk_len") / F.col("avgdl")))
    return hits.groupBy("query_id", "chunk_id").agg(F.sum(part if distinct else part * F.col("qtf")).alias("score"))


def topk(index: Bm25Index, queries: DataFrame, k: int, distinct: bool = False) -> DataFrame:
    """(query_id, chunk_id, bm25_score, bm25_rank): the k best of the whole index, equal ones by key."""
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("bm25_score", 9)), "chunk_id")
    return scores(index, queries, distinct).withColumnRenamed("score", "bm25_score").withColumn("bm25_rank", F.row_number().over(w)).where(F.col("bm25_rank") <= k)


def rerank(index: Bm25Index, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidates (query_id, chunk_id, dense_rank) with bm25_score and bm25_rank; those without a common token score 0 and keep their order."""
    found = scores(index, queries, distinct=False, candidates=candidates)
    out = candidates.join(found.withColumnRenamed("score", "bm25_score"), ["query_id", "chunk_id"], "left").fillna(0.0, ["bm25_score"])
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("bm25_score", 9)), "dense_rank")
    return out.withColumn("bm25_rank", F.row_number().over(w))
