"""Bounds that hold at any size of the tables: of batches, of files, of what is shuffled."""

import pytest
from pyspark.sql import functions as F

from corvane.functions import models
from corvane.operators import bm25, ranking
from corvane.plans import more_queries
from corvane.sources import batches, writers


def test_a_token_in_many_blocks_is_one_list(spark):
    """Blocks of a frequent token are taken apart and joined to one list in the order of its ids as text."""
    postings = spark.range(3000).selectExpr("if(id % 3 = 0, 'rare' || id, 'often') as token", "id as chunk_id")
    flat = bm25.flatten_postings(postings, block=100)
    assert flat.where("token = 'often'").count() > 10
    got = {r.token: r.doc_indices for r in bm25.whole_lists(bm25.normalize_postings(flat)).collect()}
    assert got["often"] == ",".join(sorted(str(i) for i in range(3000) if i % 3)) and got["rare999"] == "999" and len(got) == 1001


def test_counted_rows(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["b"])], "chunk_id long, tokens array<string>").coalesce(1)
    assert sorted(map(tuple, bm25.counted(rows).collect())) == [("a", 1, 2), ("b", 1, 1), ("b", 4, 1)]


def test_rows_of_one_key_are_added_up(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"]), (1, ["a"])], "chunk_id long, tokens array<string>").repartition(2)
    assert sorted(map(tuple, bm25.write_index(rows, str(tmp_path)).postings.select("token", "chunk_id", "tf").collect())) == [("a", 1, 2), ("b", 1, 1)]


def test_hits_are_added_up_where_their_chunk_is(spark, tmp_path):
    """Postings meet lengths by chunk, and no shuffle comes after the queries multiply them."""
    texts = spark.createDataFrame([(i, ["a", "b", f"c{i % 7}"]) for i in range(200)], "chunk_id long, tokens array<string>")
    index = bm25.write_index(texts, str(tmp_path))
    queries = spark.createDataFrame([(q, ["a", f"c{q}"]) for q in range(5)], "query_id long, tokens array<string>")
    plan = bm25.scores(index, queries)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan and plan.count("Exchange hashpartitioning(chunk_id") >= 1
    few = bm25.asked_in_groups(queries, index.idf, most=3)
    assert len(few) > 1 and sum(g.count() for g in few) == bm25.asked_in_groups(queries, index.idf)[0].count() == 10


def test_batches_are_bounded_by_bytes(spark):
    """Ten thousand long texts come in many batches, with whatever settings the session had."""
    for key, value in ((batches._ROWS_KEY, "10000"), (batches._BYTES_KEY, "2147483647b")):
        spark.conf.set(key, value)
    batches.bounded(spark)

    def sizes(found):
        import pyarrow as pa

        for b in found:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    texts = spark.range(10_000, numPartitions=1).select(F.repeat(F.lit("x"), F.lit(5000)).alias("t"))
    assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 2 * batches.BYTES


@pytest.mark.parametrize("by", [None, "g"])
def test_dense_topk_over_many_slabs(spark, by, monkeypatch):
    """Later vectors of a task that tie with or beat earlier ones are found, however few stand together."""
    import numpy as np

    rng = np.random.default_rng(5)
    vs = np.round(rng.normal(size=(300, 4)), 1)
    rows = [(int(i), [float(x) for x in v], int(i) % 3) for i, v in zip(rng.permutation(300), vs)]
    df = spark.createDataFrame(rows, "chunk_id long, embedding array<float>, g int").coalesce(1)
    q = df.where("chunk_id % 20 = 0").withColumnRenamed("chunk_id", "query_id")
    monkeypatch.setattr(ranking, "SLAB", 7)
    spark.conf.set(batches._ROWS_KEY, "5")
    try:
        got = sorted((r.query_id, r.dense_rank, r.chunk_id) for r in ranking.dense_topk(q, df, 9, by=by).collect())
    finally:
        spark.conf.set(batches._ROWS_KEY, str(batches.ROWS))
    exact = [(i, np.asarray(np.float32(v), float), g) for i, v, g in rows]
    want = []
    for i, v, g in exact:
        if i % 20 == 0:
            best = sorted(((-round(float(v @ w), 9), j) for j, w, h in exact if by is None or g == h))[:9]
            want += [(i, r + 1, j) for r, (_, j) in enumerate(best)]
    assert got == sorted(want)


def test_largest_keeps_what_can_still_win():
    import numpy as np

    lows = np.full(2, -np.inf)
    rows, cols = ranking._largest(np.array([[3.0, 1, 3, 2], [np.nan, 1, -np.inf, 0]]), lows, 2)
    assert [*zip(rows, cols)] == [(0, 0), (0, 2), (1, 1), (1, 3)] and list(lows) == [3, 0]
    rows, cols = ranking._largest(np.array([[3.0, 2, 2, 2], [0.0, -1, 0, -2]]), lows, 2)
    assert [*zip(rows, cols)] == [(0, 0), (1, 0), (1, 2)]


def test_lines_in_several_files(spark, tmp_path):
    """Each file has its frame, and an empty table's one file too."""
    for n, rows in ((3, 1000), (1, 1000), (1, 0)):
        path = f"{tmp_path}/{n}-{rows}"
        writers.write_lines(spark.range(rows).selectExpr("string(id) as value"), path, n, ["["], ["]"])
        files = [f.read_text().split("\n")[:-1] for f in (tmp_path / f"{n}-{rows}").glob("part-*")]
        assert len(files) == n and all(f[0] == "[" and f[-1] == "]" for f in files)
        assert sorted(int(x) for f in files for x in f[1:-1]) == list(range(rows))


@pytest.mark.parametrize("name", ["csv_one_file", "json_list_documents"])
def test_no_task_writes_all_documents(spark, sf_dir, name, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(more_queries, "FILE_BYTES", docs.agg(F.sum(F.octet_length("text"))).first()[0] // 4)
    made = []
    monkeypatch.setattr(writers, "write_lines", lambda lines, path, n, *a, f=writers.write_lines, **k: (made.append(n), f(lines, path, n, *a, **k)))
    got = getattr(more_queries, name)(spark, sf_dir)
    assert made[0] >= 4 and sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted((str(r.doc_id), r.text) for r in docs.collect())


def test_letters_in_one_pass():
    texts = ["Ab ÉÉ zz", "", "日本 😀 a|a", "İ&%", "x" * 5000]
    low = [t.lower() for t in texts]
    counts = [[t.count(c) for c in models.LetterEncoder.letters] for t in low]
    import numpy as np

    counts = np.array(counts, float)
    want = (counts / np.maximum(np.sqrt((counts * counts).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)
    assert (models.LetterEncoder().encode(texts) == want).all()


def test_blocks_meet_all_queries_at_once(spark, tmp_path, monkeypatch):
    """Bounds are added up where a range's blocks are, postings leave their blocks after the join, and groups of queries give what all give together."""
    from corvane.operators import bm25_blocks

    texts = spark.createDataFrame([(i, ["a", "b", f"c{i % 7}", f"d{i % 11}"]) for i in range(300)], "chunk_id long, tokens array<string>")
    index = bm25.write_index(texts, f"{tmp_path}/index")
    blocks = bm25_blocks.write_blocks(index, f"{tmp_path}/blocks", 8)
    assert "hashpartitioning(number" not in bm25_blocks.postings_of(blocks)._jdf.queryExecution().executedPlan().toString()
    queries = spark.createDataFrame([(q, ["a", f"c{q}", f"d{q}"]) for q in range(5)], "query_id long, tokens array<string>")
    shown = lambda: sorted((r.query_id, r.bm25_rank, r.chunk_id, round(r.bm25_score, 8)) for r in bm25_blocks.topk(blocks, queries, 4, probes=2).collect())
    whole = shown()
    monkeypatch.setattr(bm25_blocks, "asked_in_groups", lambda q, idf, f=bm25.asked_in_groups: f(q, idf, most=6))
    assert shown() == whole and len(whole) == 20


def test_a_batch_of_chunks_meets_only_its_own_documents(spark, tmp_path, monkeypatch):
    from corvane.plans import retrieval
    from corvane.streaming import index_builder

    docs = spark.createDataFrame([(i, "t", f"text {i}") for i in range(40)], "doc_id long, title string, text string")
    chunks = spark.createDataFrame([(f"{i}:chunk:0", str(i), "t", 0, 6, 0, 6, 1) for i in range(40)], "chunk_id string, doc_id string, title string, child_start int, child_end int, parent_start int, parent_end int, chunk_len int")
    chunks.repartition(4).write.parquet(f"{tmp_path}/chunks")
    met = []
    monkeypatch.setattr(retrieval, "embed", lambda todo, texts, make, done=None, f=retrieval.embed: (met.append(texts.count()), f(todo, texts, make, done))[1])
    built = index_builder.build(spark, f"{tmp_path}/chunks", chunks.schema, docs, models.LetterEncoder, f"{tmp_path}/index", f"{tmp_path}/checkpoint", files=1)
    assert built.count() == 40 and sum(met) == 40 and len(met) > 1
