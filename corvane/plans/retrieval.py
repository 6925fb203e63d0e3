"""The composite plans: preprocessing, index building, hybrid retrieval, contexts, answering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import models
from ..functions import text as T
from ..operators import bm25, chunking, qa, quality, ranking
from ..sources.indexes import IndexSet
from ..sources.scratch import stored
from .config import Config


def preprocess(docs: DataFrame, child_size: int = 128, parent_size: int = 512, least_chars: int = 100) -> tuple[DataFrame, DataFrame]:
    """Cleaned documents (doc_id, title, text, text_len) and their child chunks, as one lazy chain; bad titles become empty."""
    title = F.when(T.is_good_title(F.col("title")), T.clean_title(F.col("title"))).otherwise("")
    cleaned = docs.select("doc_id", title.alias("title"), F.explode(T.cleaned_at_least(F.col("text"), least_chars)).alias("text"))
    cleaned = cleaned.withColumn("text_len", F.length("text"))
    return cleaned, chunking.child_chunks(cleaned, child_size, parent_size)


def embed(chunks: DataFrame, docs: DataFrame, make: Callable[[], models.Encoder], done: DataFrame | None = None) -> DataFrame:
    """(chunk_id, embedding) of the chunks that are not in `done`, the output so far."""
    todo = quality.unprocessed(chunks, done) if done is not None else chunks
    texts = chunking.slices(todo, docs)
    return texts.select("chunk_id", models.encode_column(make, F.col("embedding_text")).alias("embedding"))


def retrieve(queries: DataFrame, chunks: DataFrame, index: bm25.Bm25Index, config: Config | None = None, reranker: Callable[[], models.Reranker] | None = None, diversify: bool = False) -> DataFrame:
    """The final results of each query (query_id, query, tokens, embedding) over chunks (chunk_id, doc_id, text, embedding).

    One plan over all queries: dense top-k, BM25 rescoring of just those, rank fusion, same-document boost, marginal
    relevance (cut to its size; over real vectors if `diversify`), reranking if there is a reranker, final top-k.
    Without a BM25 index the fusion has the dense ranks alone.
    """
    get = lambda key: (config or Config()).get("retrieval", key)
    dense = stored(ranking.dense_topk(queries, chunks, get("dense_top_k")))
    if index is not None:
        lexical = bm25.rerank(index, queries, dense.select("query_id", "chunk_id", "dense_rank"))
        fused = ranking.rrf(dense, lexical, get("rrf_k"))
    else:
        fused = ranking.rrf(dense, dense.where("false").withColumnRenamed("dense_rank", "bm25_rank"), get("rrf_k"))
    boosted = ranking.paragraph_boost(fused.join(chunks.select("chunk_id", "doc_id"), "chunk_id", "left"), get("alpha"))
    if diversify:
        picked = ranking.mmr(boosted.join(chunks.select("chunk_id", "embedding"), "chunk_id", "left"), get("mmr_top_k"), get("mmr_lambda"))
        cut = boosted.join(picked.select("query_id", "chunk_id", F.col("mmr_rank").alias("rank")), ["query_id", "chunk_id"])
    else:
        cut = ranking.top(boosted, "boost_rank", get("mmr_top_k")).withColumn("rank", F.col("boost_rank"))
    if reranker is None:
        return ranking.top(cut, "rank", get("final_top_k"))
    pairs = cut.join(chunks.select("chunk_id", "text"), "chunk_id").join(queries.select("query_id", "query"), "query_id")
    return ranking.rerank(pairs, get("final_top_k"), reranker).drop("text", "query").withColumn("rank", F.col("rerank_rank")).drop("rerank_rank")


def contexts(found: DataFrame, chunks: DataFrame, k: int = 3) -> DataFrame:
    """(query_id, C1..Ck) from the texts of the final results."""
    return qa.widen(found.select("query_id", "chunk_id", "rank").join(chunks.select("chunk_id", "text"), "chunk_id", "left"), k)


def answer(questions: DataFrame, make: Callable[[], models.Generator], k: int = 3) -> DataFrame:
    """questions (id, prompt, A..E, and C1..Ck if k > 0) with predicted: prompt, generation, parsing."""
    ctx = qa.context([f"C{i}" for i in range(1, k + 1)]) if k else None
    prompt = qa.choice_prompt(F.col("prompt"), [F.col(c) for c in qa.LETTERS], ctx)
    return questions.withColumn("predicted", qa.parse_answer(models.generate_column(make, prompt)))


def build_vectors(chunks: DataFrame, docs: DataFrame, make: Callable[[], models.Encoder], index: IndexSet, name: str, steps: int = 1) -> DataFrame:
    """Encodes the chunks that the named index lacks and appends them, in `steps` parts dealt by key; returns the index as stored.

    Each part that is appended is a checkpoint: a build that was broken off goes on with the chunks not yet stored.
    """
    spark = chunks.sparkSession
    for i in range(steps):
        todo = chunks.where(F.pmod(F.xxhash64("chunk_id"), F.lit(steps)) == i)
        index.save(name, embed(todo, docs, make, index.load(spark, name) if index.exists(spark, name) else None))
    return index.load(spark, name)


def evaluate(questions: DataFrame, make: Callable[[], models.Generator], path: str, truth: str = "answer", k: int = 3) -> DataFrame:
    """Answers questions, writes predictions, accuracy, the distribution of answers and wrong rows below path; returns the accuracy as stored."""
    answer(questions, make, k).write.mode("overwrite").parquet(f"{path}/predictions")
    predicted = questions.sparkSession.read.parquet(f"{path}/predictions")
    qa.accuracy(predicted, "predicted", truth).write.mode("overwrite").parquet(f"{path}/accuracy")
    qa.distribution(predicted, "predicted").write.mode("overwrite").parquet(f"{path}/distribution")
    qa.error_rows(predicted, "predicted", truth).write.mode("overwrite").parquet(f"{path}/errors")
    return questions.sparkSession.read.parquet(f"{path}/accuracy")


def answer_with_retrieval(questions: DataFrame, chunks: DataFrame, index: bm25.Bm25Index | None, encode: Callable[[], models.Encoder], generate: Callable[[], models.Generator], path: str, config: Config | None = None, truth: str = "answer") -> DataFrame:
    """questions (id, prompt, A..E, truth) end to end: encoded, retrieved for, put into contexts, answered and evaluated below path."""
    asked = stored(questions.select(F.col("id").alias("query_id"), F.col("prompt").alias("query"), bm25.word_tokens(F.col("prompt")).alias("tokens"), models.encode_column(encode, qa.query_text(F.col("prompt"))).alias("embedding")))
    wide = contexts(retrieve(asked, chunks, index, config), chunks)
    return evaluate(questions.join(wide, questions["id"] == wide["query_id"], "left").drop("query_id"), generate, path, truth)
