"""Rankings: exact vector top-k, fusion, boosting, marginal relevance, reranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import models
from ..sources.batches import bounded
from ..sources.scratch import stored


#: Vectors of a slab and values of a product at most, some 16 MB each at 64 dimensions.
SLAB, CELLS = 1 << 15, 1 << 21


def _slabs(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array]]:
    """(keys, vectors, groups) of up to SLAB rows (key, vector, group)."""
    held: list[tuple] = []

    def joined() -> tuple[pa.Array, np.ndarray, pa.Array]:
        keys, ms, groups = zip(*held)
        return pa.concat_arrays(keys), np.concatenate(ms), pa.concat_arrays(groups)

    for batch in batches:
        for low in range(0, batch.num_rows, SLAB):
            part = batch.slice(low, SLAB)
            if held and sum(len(h[0]) for h in held) + part.num_rows > SLAB:
                yield joined()
                held.clear()
            m = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            held.append((part.column(0), m, part.column(2)))
    if held:
        yield joined()


def _by_group(groups: pa.Array) -> tuple[np.ndarray, dict]:
    """(places, spans): the rows' places with those of a group together, in the order they had, and of each group where it begins and ends there."""
    coded = groups.dictionary_encode()
    codes = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
    names, ends = coded.dictionary.to_pylist() + [None], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary) + 1)).tolist()
    return np.argsort(codes, kind="stable"), {g: (low, high) for g, low, high in zip(names, [0, *ends], ends) if low < high}


def _lower_bounds(s: np.ndarray, k: int) -> np.ndarray:
    """A value for each row that k of its finite values reach, as rounded: the kth value, or in wide tables the kth of the largest of 16 k parts."""
    if (width := s.shape[1] // (16 * k)) > 1:
        s = s[:, : 16 * k * width].reshape(len(s), 16 * k, width).max(axis=2)
    t = np.where(np.isfinite(s), s, -np.inf)
    return np.round(np.partition(t, t.shape[1] - k, axis=1)[:, t.shape[1] - k], 9)


def _largest(s: np.ndarray, lows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of each row's k largest finite values as rounded, the first columns of equals, left out where lower than lows, which rise to the kth value found."""
    if s.shape[1] > k and (fresh := np.flatnonzero(lows == -np.inf)).size:
        lows[fresh] = _lower_bounds(s[fresh] if len(fresh) < len(s) else s, k)
    rows, cols = np.nonzero(s >= lows[:, None] - 1e-9)
    value = s[rows, cols]
    ok = np.isfinite(value)
    rows, cols, value = rows[ok], cols[ok], np.round(value[ok], 9)
    # Of those that equal the bound the first k are enough: copies of a vector are many.
    tied = value == lows[rows]
    upto = np.concatenate([[0], np.cumsum(tied)])
    ok = (value > lows[rows]) | tied & (upto[1:] - upto[np.searchsorted(rows, np.arange(len(lows)))[rows]] <= k)
    rows, cols, value = rows[ok], cols[ok], value[ok]
    order = np.lexsort((cols, -value, rows))
    rows, cols, value = rows[order], cols[order], value[order]
    first = np.searchsorted(rows, np.arange(len(lows)))
    place = np.arange(len(rows)) - first[rows]
    full = place == k - 1
    lows[rows[full]] = np.maximum(lows[rows[full]], value[full])
    return rows[place < k], cols[place < k]


def dense_topk(queries: DataFrame, corpus: DataFrame, k: int, block_bytes: int = 64 << 20, query_id: str = "query_id", key: str = "chunk_id", vector: str = "embedding", by: str | None = None, at_once: int = 1024) -> DataFrame:
    """(query_id, chunk_id, similarity, dense_rank): the k best by inner product, equal ones by key.

    Query vectors, of at most block_bytes, are all that is ever broadcast; more of them go in blocks of that size, read from
    a stored table, and each block's best are written before the next one's begin. A block meets the whole corpus in one
    pass, in matrix products of at most CELLS values: up to at_once queries with a slab of up to SLAB vectors. A slab passes
    on its k best, as far as they reach the kth best of an earlier slab of the task, and a window takes the k best of those. The dimension is that of most queries; vectors that are null or of another one are left out. With
    fewer than k vectors there are fewer rows. by: only vectors that agree with the query in this column are multiplied; null agrees with nothing.
    """
    named = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("v"), (F.col(by) if by else F.lit(None).cast("string")).alias("g")).where("v is not null")
    bounded(queries.sparkSession)
    named = stored(named.where("g is not null") if by else named)
    sizes = named.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    spark, dim, total = queries.sparkSession, (sizes["d"] if sizes else 0), (sizes["count"] if sizes else 0)
    named = named.where(F.size("v") == dim)
    n_blocks = max(1, -(-total * dim * 8 // block_bytes))
    corpus = corpus.select(F.col(key).alias("chunk_id"), F.col(vector).alias("v"), (F.col(by) if by else F.lit(None).cast("string")).alias("g")).where((F.size("v") == dim) & F.lit(total > 0))
    corpus = corpus.where("g is not null") if by else corpus
    schema = f"query_id {dict(named.dtypes)['query_id']}, chunk_id {dict(corpus.dtypes)['chunk_id']}, similarity double"
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 9)), "chunk_id")
    id_type = to_arrow_type(named.schema["query_id"].dataType)
    every = None
    for i in range(n_blocks):
        rows = (named if n_blocks == 1 else named.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == i)).toArrow().combine_chunks()
        ids, v, g = (pa.concat_arrays(rows.column(c).chunks) if rows.num_rows else pa.array([], rows.schema.field(c).type) for c in ("query_id", "v", "g"))
        places, spans = _by_group(g)
        sent = spark.sparkContext.broadcast((ids.cast(id_type).take(pa.array(places)), v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), dim)[places].astype(np.float64), spans))

        def best(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, q, spans = sent.value
            lows = np.full(len(ids), -np.inf)
            for keys, m, groups in _slabs(batches, dim):
                order = pc.sort_indices(keys)
                places, parts = _by_group(groups.take(order))
                at = order.to_numpy()[places]
                keys, m, found, n = keys.take(pa.array(at)), m[at], [], 0
                for g, (start, end) in parts.items():
                    first, last = spans.get(g, (0, 0))
                    step = max(1, min(at_once, CELLS // (end - start)))
                    for low in range(first, last, step):
                        s = q[low : min(low + step, last)] @ m[start:end].T
                        rows, cols = _largest(s, lows[low : min(low + step, last)], k)
                        found.append((low + rows, start + cols, s[rows, cols]))
                        n += len(rows)
                        if n >= CELLS >> 4:
                            yield passed(ids, keys, found)
                            found, n = [], 0
                if n:
                    yield passed(ids, keys, found)

        def passed(ids: pa.Array, keys: pa.Array, found: list[tuple]) -> pa.RecordBatch:
            rows, cols, values = map(np.concatenate, zip(*found))
            return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), keys.take(pa.array(cols)), pa.array(values)], names=["query_id", "chunk_id", "similarity"])

        part = corpus.mapInArrow(best, schema).withColumn("dense_rank", F.row_number().over(w)).where(F.col("dense_rank") <= k)
        if n_blocks > 1:
            part = stored(part)
            sent.unpersist()
        every = part if every is None else every.unionByName(part)
    return every


def rrf(dense: DataFrame, lexical: DataFrame, k: int = 30) -> DataFrame:
    """(query_id, chunk_id, rrf, rrf_rank) from (query_id, chunk_id, dense_rank) and (query_id, chunk_id, bm25_rank): the sum of 1 / (k + rank). Ties go by dense, then by lexical rank."""
    d = dense.select("query_id", "chunk_id", "dense_rank", F.lit(None).cast("int").alias("bm25_rank"))
    s = lexical.select("query_id", "chunk_id", F.lit(None).cast("int").alias("dense_rank"), "bm25_rank")
    both = d.unionByName(s).groupBy("query_id", "chunk_id").agg(F.min("dense_rank").alias("dense_rank"), F.min("bm25_rank").alias("bm25_rank"))
    score = F.coalesce(1 / (k + F.col("dense_rank")), F.lit(0.0)) + F.coalesce(1 / (k + F.col("bm25_rank")), F.lit(0.0))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("rrf", 12)), F.asc_nulls_last("dense_rank"), "bm25_rank")
    return both.withColumn("rrf", score).withColumn("rrf_rank", F.row_number().over(w))


def paragraph_boost(fused: DataFrame, alpha: float = 0.03, doc: str = "doc_id", score: str = "rrf", rank: str = "rrf_rank") -> DataFrame:
    """fused with n (results of the same document), boosted = score * (1 + alpha * e^n), and boost_rank. A null document stands for itself."""
    of_doc = Window.partitionBy("query_id", F.coalesce(F.col(doc).cast("string"), F.concat(F.lit("\0"), F.col("chunk_id").cast("string"))))
    out = fused.withColumn("n", F.count("*").over(of_doc)).withColumn("boosted", F.col(score) * (1 + alpha * F.exp("n")))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round(F.log("boosted"), 9)), rank)
    return out.withColumn("boost_rank", F.row_number().over(w))


def top(ranked: DataFrame, rank: str, k: int) -> DataFrame:
    return ranked.where(F.col(rank) <= k)


def mmr(ranked: DataFrame, k: int, lam: float = 0.8, score: str = "boosted", rank: str = "boost_rank", vector: str = "embedding") -> DataFrame:
    """(query_id, chunk_id, mmr, mmr_rank): greedily the largest lam * score - (1 - lam) * largest cosine to those chosen (0 at least).

    The first choice counts with its bare score, and so does a result without a vector, whenever chosen. The first of
    equals wins. All of a query's candidates take part; they are the results of a ranking, whose k bounds a group.
    """
    kinds = dict(ranked.dtypes)
    schema = f"query_id {kinds['query_id']}, chunk_id {kinds['chunk_id']}, mmr double, mmr_rank int"

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("r").reset_index(drop=True)
        has = pdf["v"].map(lambda v: v is not None and len(v) > 0).to_numpy(bool)
        rel, n = pdf["s"].to_numpy(float), len(pdf)
        dim = next((len(v) for v, h in zip(pdf["v"], has) if h), 1)
        m = np.stack([np.asarray(v, float) if h else np.zeros(dim) for v, h in zip(pdf["v"], has)])
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        near, left, out = np.zeros(n), np.ones(n, bool), []
        while left.any() and len(out) < k:
            value = rel if not out else np.where(has, lam * rel - (1 - lam) * near, rel)
            i = int(np.argmax(np.where(left, np.round(value, 12), -np.inf)))
            out.append((pdf["query_id"][i], pdf["chunk_id"][i], float(value[i]), len(out) + 1))
            left[i] = False
            if has[i]:
                near = np.maximum(near, m @ m[i])
        return pd.DataFrame(out, columns=["query_id", "chunk_id", "mmr", "mmr_rank"])

    cut = ranked.select("query_id", "chunk_id", F.col(score).alias("s"), F.col(rank).alias("r"), F.col(vector).alias("v"))
    return cut.groupBy("query_id").applyInPandas(choose, schema)


def rerank(candidates: DataFrame, k: int, make: Callable[[], models.Reranker] = models.OverlapReranker, query: str = "query", text: str = "text", rank: str = "rank") -> DataFrame:
    """candidates with rerank_score and rerank_rank, the k best of each query; empty texts are skipped, ties keep their order."""
    scored = candidates.where(F.coalesce(F.col(text), F.lit("")) != "").withColumn("rerank_score", models.rerank_column(make, F.col(query), F.col(text)))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("rerank_score", 9)), rank)
    return scored.withColumn("rerank_rank", F.row_number().over(w)).where(F.col("rerank_rank") <= k)


def rerank_in_batches(candidates: DataFrame, make: Callable[[], models.Reranker], batch: int = 32, query: str = "query", text: str = "text", place: str = "rank", growth: float = 1.25) -> DataFrame:
    """candidates (query_id, chunk_id, place, query, text) with rerank_score and rerank_rank; blank texts are skipped, but places count them, equal scores go by place.

    The model sees batches of pairs of one length class, whose longest is at most `growth` times their shortest, whatever
    queries they belong to; a pair's score goes back to its query and place. A class's last batch of a task may be smaller.
    """
    kinds = dict(candidates.dtypes)
    schema = f"query_id {kinds['query_id']}, chunk_id {kinds['chunk_id']}, place {kinds[place]}, rerank_score double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, held = make(), {}

        def scored(rows: list[tuple]) -> pd.DataFrame:
            found = model.scores([r[3] for r in rows], [r[4] for r in rows])
            if len(found) != len(rows):
                raise ValueError(f"{len(found)} scores for {len(rows)} pairs")
            return pd.DataFrame([(*r[:3], float(x)) for r, x in zip(rows, found)], columns=["query_id", "chunk_id", "place", "rerank_score"])

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                of_class = held.setdefault(int(np.log(len(row.query) + len(row.text)) / np.log(growth)), [])
                of_class.append(tuple(row))
                if len(of_class) == batch:
                    yield scored(of_class)
                    of_class.clear()
        for rows in held.values():
            if rows:
                yield scored(rows)

    pairs = candidates.select("query_id", "chunk_id", F.col(place).alias("place"), F.coalesce(F.col(query), F.lit("")).alias("query"), F.col(text).alias("text")).where(F.trim(F.coalesce("text", F.lit(""))) != "")
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("rerank_score", 9)), "place")
    return pairs.mapInPandas(score, schema).withColumn("rerank_rank", F.row_number().over(w))


def self_retrieval(sample: DataFrame, corpus: DataFrame, k: int = 5, key: str = "chunk_id", doc: str = "doc_id") -> DataFrame:
    """The k nearest of each sampled vector, with is_self and is_same_doc."""
    found = dense_topk(sample.withColumn("query_id", F.col(key)), corpus, k, key=key)
    docs = corpus.select(F.col(key).alias("chunk_id"), F.col(doc).alias("hit_doc"))
    own = sample.select(F.col(key).alias("query_id"), F.col(doc).alias("own_doc"))
    return found.join(docs, "chunk_id").join(own, "query_id").select("query_id", "chunk_id", "similarity", "dense_rank", (F.col("query_id") == F.col("chunk_id")).alias("is_self"), F.col("own_doc").eqNullSafe(F.col("hit_doc")).alias("is_same_doc"))


def vector_report(vectors: DataFrame, vector: str = "embedding", expected: int | None = None) -> DataFrame:
    """One row: number, dimension, invalid vectors, missing and surplus against an expected number, bytes at half precision."""
    dim = F.max(F.size(vector))
    out = vectors.agg(F.count(vector).alias("ntotal"), dim.cast("long").alias("dim"), F.count_if(F.col(vector).isNull() | (F.size(vector) <= 0)).alias("invalid"), F.count("*").alias("n_rows"))
    want = F.lit(expected) if expected is not None else F.col("n_rows")
    return out.select("ntotal", "dim", "invalid", F.greatest(want - F.col("ntotal"), F.lit(0)).alias("missing_vectors"), F.greatest(F.col("ntotal") - want, F.lit(0)).alias("extra_vectors"), (F.col("ntotal") * F.col("dim") * 2).alias("size_bytes"))


def probe_search(vectors: DataFrame, n: int = 5, k: int = 5, key: str = "chunk_id", vector: str = "embedding") -> DataFrame:
    """(query_id, n_found, self_rank): what a search of the index gives for n stored vectors, the first in hash order; self_rank is null if a vector is not among its own k nearest.

    An index that cannot be searched fails here; one whose vectors are not normalised or do not belong to their keys shows it by its ranks.
    """
    from .sampling import sample_rows

    asked = stored(sample_rows(vectors.where(F.size(vector) > 0).select(F.col(key).alias("query_id"), F.col(vector).alias("embedding")), "query_id", n))
    found = dense_topk(asked, vectors, k, key=key, vector=vector)
    return found.groupBy("query_id").agg(F.count("*").alias("n_found"), F.min(F.when(F.col("query_id") == F.col("chunk_id"), F.col("dense_rank"))).alias("self_rank"))
