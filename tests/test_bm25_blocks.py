import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import bm25, bm25_blocks


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Texts of skewed words, of lengths from none to many, with copies, and short and long queries, one without a known word."""
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(40_000)]
    texts = [" ".join(rng.sample(words, rng.choice((0, 1, 5, 30, 120)))) for _ in range(600)]
    texts += texts[:20] + [None] + [f"rare{i} " * 3 + "w1" for i in range(12)]
    docs = bm25.tokenize(spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3), "id", "text")
    asked = ["w1 w2 w7 w7", "rare3 w1 w1 w2", "unheard", "w5", " ".join(rng.sample(words, 40)), "rare1 rare2 rare9"]
    queries = spark.createDataFrame([(f"q{i}", a.split()) for i, a in enumerate(asked)], "query_id string, tokens array<string>")
    index = bm25.write_index(docs, str(tmp_path_factory.mktemp("bm25")))
    return index, queries


def shown(df):
    return sorted((r.query_id, r.bm25_rank, r.chunk_id, round(r.bm25_score, 8)) for r in df.collect())


@pytest.mark.parametrize(("size", "probes", "k", "distinct"), [(16, 4, 10, False), (8, 1, 3, True), (64, 2, 1000, False), (1, 5, 2, False)])
def test_blocks_give_what_full_scoring_gives(tables, tmp_path, size, probes, k, distinct):
    index, queries = tables
    blocks = bm25_blocks.write_blocks(index, str(tmp_path), size)
    assert shown(bm25_blocks.topk(blocks, queries, k, distinct, probes)) == shown(bm25.topk(index, queries, k, distinct))
    row = bm25_blocks.blocks_read(blocks, queries, k, distinct, probes).first()
    assert 0 < row.blocks_read <= row.blocks and row.share == row.blocks_read / row.blocks


def test_rare_words_leave_most_blocks_unread(tables, tmp_path):
    """Queries of a rare and a common word: blocks of the common one alone cannot reach the third best."""
    index, queries = tables
    blocks = bm25_blocks.write_blocks(index, str(tmp_path), 8)
    some = queries.where("query_id in ('q1', 'q5')").withColumn("tokens", F.when(F.col("query_id") == "q1", F.array(F.lit("rare3"), F.lit("w1"))).otherwise(F.col("tokens")))
    assert bm25_blocks.blocks_read(blocks, some, 1, probes=2).first().share < 0.2


def test_postings_come_back(tables, tmp_path):
    index, _ = tables
    blocks = bm25_blocks.write_blocks(index, str(tmp_path), 16)
    rows = lambda df: sorted(map(tuple, df.select("token", "chunk_id", "tf").collect()))
    assert rows(bm25_blocks.postings_of(blocks)) == rows(index.postings)
    assert blocks.blocks.where("n > 16 or n != size(gaps)").isEmpty()
