import math
from collections import Counter

import numpy as np
import pytest

from corvane.functions import models
from corvane.operators import bm25, ranking
from corvane.plans import retrieval
from corvane.plans.config import Config


@pytest.fixture(scope="module")
def texts():
    return {1: "red fox red den", 2: "blue fox", 3: "green sea and sea", 4: "", 5: None, 6: "red red red"}


@pytest.fixture(scope="module")
def index(spark, texts):
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    return bm25.build_index(bm25.tokenize(df, "doc_id", "text"))


def expected(texts, query, distinct):
    docs = {i: (t or "").split() for i, t in texts.items()}
    n, avg = len(docs), np.mean([len(d) for d in docs.values()])
    out = {}
    for i, d in docs.items():
        s = 0.0
        for w in dict.fromkeys(query) if distinct else query:
            df = sum(w in x for x in docs.values())
            if tf := d.count(w):
                s += math.log((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / avg))
        if s:
            out[i] = s
    return out


@pytest.mark.parametrize("distinct", [True, False])
def test_scores(spark, index, texts, distinct):
    query = ["red", "red", "sea", "unknown"]
    q = spark.createDataFrame([(9, query)], "query_id long, tokens array<string>")
    got = {r.chunk_id: r.score for r in bm25.scores(index, q, distinct).collect()}
    assert got == pytest.approx(expected(texts, query, distinct))
    cut = spark.createDataFrame([(9, 1), (9, 4)], "query_id long, chunk_id long")
    assert set(r.chunk_id for r in bm25.scores(index, q, distinct, cut).collect()) == {1}


def test_rerank_keeps_zero_scores_in_dense_order(spark, index):
    q = spark.createDataFrame([(9, ["red"])], "query_id long, tokens array<string>")
    cand = spark.createDataFrame([(9, 3, 1), (9, 2, 2), (9, 1, 3), (9, 6, 4)], "query_id long, chunk_id long, dense_rank int")
    out = bm25.rerank(index, q, cand).orderBy("bm25_rank").collect()
    assert [r.chunk_id for r in out] == [6, 1, 3, 2] and out[2].bm25_score == 0


def test_index_round_trip_and_lookup(spark, index, texts, tmp_path):
    docs = spark.createDataFrame([*texts.items()], "chunk_id long, text string")
    bm25.write_index(bm25.tokenize(docs, "chunk_id", "text"), str(tmp_path))
    again = bm25.read_index(spark, str(tmp_path))
    for name in ("lengths", "idf", "metadata"):
        one, two = (getattr(x, name) for x in (index, again))
        assert sorted(map(str, one.select(*sorted(one.columns)).collect())) == sorted(map(str, two.select(*sorted(two.columns)).collect()))
    assert spark.read.parquet(f"{tmp_path}/tokenized_chunks").count() == len(texts)
    assert Counter(again.postings.select(*sorted(again.postings.columns)).collect()) == Counter(index.postings.select(*sorted(index.postings.columns)).collect())
    assert {r.chunk_id: r.tf for r in bm25.lookup(again, "red").collect()} == {1: 2, 6: 3}
    plan = bm25.lookup(again, "red")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(token,red)" in plan
    flat = bm25.flatten_postings(index.postings)
    assert {r.doc_indices for r in flat.where("token = 'fox'").collect()} == {"1,2"}
    many = spark.range(1000).selectExpr("'a' as token", "id as chunk_id")
    blocks = bm25.flatten_postings(many, block=100).collect()
    assert len(blocks) == 10 and max(len(r.doc_indices.split(",")) for r in blocks) < 200
    assert sorted(int(r.chunk_id) for r in bm25.normalize_postings(bm25.flatten_postings(many, block=100)).collect()) == list(range(1000))


def vectors(spark, rows, key="chunk_id"):
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>, doc_id string")


def test_dense_topk_in_blocks(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(50, 8)).astype(np.float32)
    corpus = vectors(spark, [(i, v.tolist(), str(i % 3)) for i, v in enumerate(data)] + [(90, None, "x"), (91, [1.0], "x")])
    queries = vectors(spark, [(i, data[i].tolist(), str(i % 3)) for i in range(9)], "query_id")
    want = {(q, int(i)): r + 1 for q in range(9) for r, i in enumerate(np.argsort(-(data @ data[q]), kind="stable")[:4])}
    for block_bytes, at_once in ((4 * 8 * 8, 3), (1 << 20, 2), (1 << 20, 1024)):
        assert {(r.query_id, r.chunk_id): r.dense_rank for r in ranking.dense_topk(queries, corpus, 4, block_bytes, at_once=at_once).collect()} == want
    # One dimension for all queries, whatever block they are in.
    odd = queries.unionByName(vectors(spark, [(20 + i, [1.0, 2.0], "0") for i in range(5)], "query_id"))
    for block_bytes in (8 * 8, 1 << 20):
        assert {r.query_id for r in ranking.dense_topk(odd, corpus, 4, block_bytes).collect()} == set(range(9))
    grouped = ranking.dense_topk(queries, corpus, 100, by="doc_id").collect()
    assert len(grouped) == 9 * 17 - 3 and all(r.query_id % 3 == r.chunk_id % 3 for r in grouped)
    assert ranking.dense_topk(queries.where("false"), corpus, 4).collect() == []


def test_rrf_boost_and_mmr(spark):
    d = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3)], "query_id long, chunk_id string, dense_rank int")
    s = spark.createDataFrame([(1, "c", 1), (1, "d", 2), (1, "b", 3)], "query_id long, chunk_id string, bm25_rank int")
    out = {r.chunk_id: r for r in ranking.rrf(d, s).collect()}
    assert out["c"].rrf == pytest.approx(1 / 33 + 1 / 31) and [out[k].rrf_rank for k in "cbad"] == [1, 2, 3, 4]
    docs = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "chunk_id string, doc_id string")
    boosted = {r.chunk_id: r for r in ranking.paragraph_boost(ranking.rrf(d, s).join(docs, "chunk_id")).collect()}
    assert boosted["a"].boosted == pytest.approx(out["a"].rrf * (1 + 0.03 * math.exp(2))) and boosted["d"].n == 1

    rng = np.random.default_rng(3)
    m, rel = rng.normal(size=(12, 4)), np.sort(rng.random(12))[::-1]
    has = [i != 5 for i in range(12)]
    rows = [(1, i, float(rel[i]), i + 1, m[i].tolist() if has[i] else None) for i in range(12)]
    df = spark.createDataFrame(rows, "query_id long, chunk_id long, boosted double, boost_rank int, embedding array<double>")
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    chosen, left = [0], list(range(1, 12))
    while len(chosen) < 7:
        value = [0.8 * rel[i] - 0.2 * max(0, *(cos(m[i], m[j]) for j in chosen if has[j]), 0) if has[i] else rel[i] for i in left]
        chosen.append(left.pop(int(np.argmax(value))))
    assert [r.chunk_id for r in ranking.mmr(df, 7).orderBy("mmr_rank").collect()] == chosen


def test_rerank_and_models(spark):
    rows = [(1, "a", "green tea", "tea is green", 1), (1, "b", "green tea", "", 2), (1, "c", "green tea", "coffee", 3), (1, "d", "green tea", "tea", 4)]
    df = spark.createDataFrame(rows, "query_id long, chunk_id string, query string, text string, rank int")
    assert [(r.chunk_id, r.rerank_score) for r in ranking.rerank(df, 2).orderBy("rerank_rank").collect()] == [("a", 1.0), ("d", 0.5)]
    v = models.HashingEncoder(16).encode(["a b", "", None])
    assert np.linalg.norm(v[0]) == pytest.approx(1) and not v[1:].any()


def test_retrieve_without_bm25_and_with_real_vectors(spark, texts):
    rng = np.random.default_rng(1)
    chunks = spark.createDataFrame([(i, f"d{i % 2}", t or "", rng.normal(size=4).tolist()) for i, t in texts.items()], "chunk_id long, doc_id string, text string, embedding array<double>")
    queries = spark.createDataFrame([(1, "red fox", ["red", "fox"], rng.normal(size=4).tolist())], "query_id long, query string, tokens array<string>, embedding array<double>")
    index = bm25.build_index(bm25.tokenize(chunks, "chunk_id", "text"))
    for options in ({"index": None}, {"index": index}, {"index": index, "diversify": True}, {"index": index, "reranker": models.OverlapReranker}):
        out = retrieval.retrieve(queries, chunks, **options).collect()
        assert sorted(r["rank"] for r in out) == [1, 2, 3]
    wide = retrieval.contexts(retrieval.retrieve(queries, chunks, index), chunks, 5).first()
    assert wide.C4 == wide.C5 == ""
    assert Config({"a": {"b": 1}}).get("a", "b") == 1 and Config().get("no", "such", default=5) == 5


def test_diversified_retrieval_keeps_all_configured_candidates(spark):
    rng = np.random.default_rng(2)
    chunks = spark.createDataFrame([(i, f"d{i}", "", rng.normal(size=4).tolist()) for i in range(620)], "chunk_id long, doc_id string, text string, embedding array<double>")
    queries = spark.createDataFrame([(1, "red", ["red"], rng.normal(size=4).tolist())], "query_id long, query string, tokens array<string>, embedding array<double>")
    config = Config({"retrieval": {"dense_top_k": 620, "rrf_k": 30, "alpha": 0.03, "mmr_lambda": 0.8, "mmr_top_k": 620, "final_top_k": 620}})
    assert retrieval.retrieve(queries, chunks, None, config, diversify=True).count() == 620


def test_preprocess_embed_and_resume(spark):
    docs = spark.createDataFrame([(1, "Good title.pdf", "The cell is a unit of life and it holds much. " * 20), (2, "file_1", "short")], "doc_id long, title string, text string")
    cleaned, chunks = retrieval.preprocess(docs)
    assert [(r.doc_id, r.title) for r in cleaned.collect()] == [(1, "Good title")]
    first = retrieval.embed(chunks.limit(1), cleaned, models.HashingEncoder).select("chunk_id").collect()
    rest = retrieval.embed(chunks, cleaned, models.HashingEncoder, done=spark.createDataFrame(first)).collect()
    assert {r.chunk_id for r in rest} | {r.chunk_id for r in first} == {r.chunk_id for r in chunks.collect()} and len(rest) == chunks.count() - 1
    assert len(rest[0].embedding) == 64


def test_batch_models():
    assert models.rank(models.OverlapReranker(), "green tea", ["coffee", "", "green tea", "tea"], batch=2) == [(2, 1.0), (3, 0.5), (0, 0.0)]
    assert [i for i, _ in models.rank(models.OverlapReranker(), "a", ["a", "b", "a"], k=1)] == [0]
    values = np.array([[0.1, 9.0, 0.3, 0.2], [0.5, 9.0, 0.3, 0.2]])
    assert models.LetterGenerator(lambda prompts: values, {"A": 0, "B": 2, "C": 3}).answer(["x", "y"]) == ["B", "A"]
    assert models.LongestOptionGenerator().answer(["Q\nA: ab\nB: abc\nC: \nAnswer:", "none", None]) == ["B", "A", "A"]
    seen = []

    def vectors_of(ids):
        seen.append(len(ids))
        return np.array([[len(i), 1.0] for i in ids])

    out = models.BatchEncoder(models.QuarterTokenizer(), vectors_of, 2, batch_size=2, longest=3, normalize=False).encode(["x" * 40, "", "x" * 8, None, "x" * 4])
    assert out[:, 0].tolist() == [3, 0, 2, 0, 1] and seen == [2, 2, 1]


def test_index_set_checks_and_resumes(spark, tmp_path):
    from corvane.sources.indexes import IndexSet

    docs = spark.createDataFrame([(i, f"Title number {i}", "The cell is a unit of life and it holds much. " * 30) for i in range(4)], "doc_id long, title string, text string")
    _, chunks = retrieval.preprocess(docs)
    index = IndexSet({"h": str(tmp_path / "v"), "none": str(tmp_path / "none")})
    assert index.checked(spark, "none") == (None, False)
    for _ in range(2):  # the second build finds nothing left to do
        out = retrieval.build_vectors(chunks, docs, models.HashingEncoder, index, "h", steps=3)
        assert sorted(r.chunk_id for r in out.collect()) == sorted(r.chunk_id for r in chunks.collect())
    assert index.checked(spark, "h")[1]


def test_answering_end_to_end(spark, texts, tmp_path):
    rng = np.random.default_rng(1)
    chunks = spark.createDataFrame([(i, f"d{i % 2}", t or "", rng.normal(size=64).tolist()) for i, t in texts.items()], "chunk_id long, doc_id string, text string, embedding array<double>")
    rows = [(i, f"red fox {i}", "a", "bb", "ccc", "d", "e", "C" if i else "A") for i in range(4)]
    questions = spark.createDataFrame(rows, "id long, prompt string, A string, B string, C string, D string, E string, answer string")
    out = retrieval.answer_with_retrieval(questions, chunks, None, models.HashingEncoder, models.LongestOptionGenerator, str(tmp_path)).first()
    assert out.n == 4 and out.accuracy == 0.75 and [r.id for r in spark.read.parquet(f"{tmp_path}/errors").collect()] == [0]
    assert spark.read.parquet(f"{tmp_path}/predictions").where("concat(C1, C2, C3) <> ''").count() == 4
