import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.functions import models
from corvane.operators import qa, ranking
from corvane.sources import readers


def test_letters_with_several_tokens(spark):
    rows = [([0.1, 0.5, 0.2, 0.2], "A"), ([0.1, 0.2, 0.3, 0.3], "C"), ([0.0], "A"), ([], "A"), (None, "A"), ([0.2, 0.2, 0.2, 0.2], "A")]
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(rows)], "i int, v array<double>, want string")
    ids = {"A": [1], "B": [0, 0], "C": [2, 3, 9], "D": [0], "E": []}
    out = df.select("want", qa.best_letter(qa.summed_letters(F.col("v"), ids)).alias("got")).collect()
    assert [r.got for r in out[:2]] == ["A", "C"] and [r.got for r in out[2:5]] == ["A"] * 3 and out[5].got == "C"
    model = models.LetterGenerator(lambda prompts: np.array([[0.4, 0.3, 0.3, 9.0]] * len(prompts)), {"A": 0, "B": [1, 2, 1]})
    assert model.answer(["x", "y"]) == ["B", "B"]


def test_next_tokens_of_cut_prompts():
    seen = []

    class Words:
        def encode(self, text):
            return [*range(len(text))]

        def decode(self, ids):
            return "ABC"[ids[0]]

    def values(ids):
        seen.append([len(i) for i in ids])
        return np.array([[len(i) % 3 == j for j in range(3)] for i in ids], float)

    model = models.NextTokenGenerator(Words(), values, longest=10, batch_size=2)
    assert model.answer(["x" * 4, "y" * 50, None, "z" * 2]) == ["B", "B", "A", "C"] and seen == [[4, 10], [0, 2]]


@pytest.mark.parametrize("batch", [1, 3, 100])
def test_reranking_in_batches_is_as_reranking(spark, batch):
    rng = np.random.default_rng(3)
    words = lambda n: " ".join(rng.choice(["a", "b", "c", "dd", "eee"], n))
    rows = [(q, f"c{i}", i + 1, f"a c eee{q}", words(int(rng.integers(1, 200)))) for q in range(6) for i in range(30)] + [(0, "blank", 31, "a", " "), (1, "null", 31, "a", None), (2, "tie", 32, None, "x")]
    df = spark.createDataFrame(rows, "query_id long, chunk_id string, rank int, query string, text string").repartition(3)

    class Watched(models.OverlapReranker):
        def scores(self, queries, texts):
            sizes = [len(q) + len(t) for q, t in zip(queries, texts)]
            assert len(sizes) <= batch and max(sizes) <= 1.26 * min(sizes) + 1
            return super().scores(queries, texts)

    show = lambda df: sorted((r.query_id, r.rerank_rank, r.chunk_id, round(r.rerank_score, 9)) for r in df.collect())
    assert show(ranking.rerank_in_batches(df, Watched, batch)) == show(ranking.rerank(df.where("trim(text) <> ''"), 100, models.OverlapReranker))


def test_probes(spark):
    v = [(i, [float(i == j) for j in range(8)]) for i in range(8)] + [(9, None), (10, [])]
    df = spark.createDataFrame(v, "chunk_id long, embedding array<float>")
    assert [(r.n_found, r.self_rank) for r in ranking.probe_search(df, 3, 2).collect()] == [(2, 1)] * 3
    assert ranking.probe_search(df.where("chunk_id > 8"), 3, 2).count() == 0


def test_marks_of_files(spark, tmp_path):
    files = {"a": b'{"x": [1]}\n', "b": b"[1, 2", "c": b"IxF2" + bytes(range(12)), "d": b"Index of words", "e": bytes(range(16)), "f": b"PAR1....PAR1"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    kinds = {r.path.rsplit("/", 1)[-1][:1]: r.kind for r in readers.file_kinds(spark, str(tmp_path)).where("path not like '%_SUCCESS%'").collect()}
    assert kinds == {"a": "json", "b": "text", "c": "index", "d": "text", "e": "binary", "f": "parquet", "p": "parquet"}
