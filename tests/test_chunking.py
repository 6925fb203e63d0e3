import random

from pyspark.sql import functions as F

from corvane.operators import chunking as C

TEXT = "Cells hold organelles. Mitochondria make energy! Does it end? " * 30


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, title string, text string")


def test_child_chunks_cover_and_fit(spark):
    out = C.child_chunks(docs(spark, [(1, "T" * 40, TEXT), (2, "", "short."), (3, None, None), (4, "", "x" * 900)])).collect()
    one = [r for r in out if r.doc_id == "1"]
    assert {r.doc_id for r in out} == {"1", "4"} and [r.chunk_id for r in one] == [f"1:chunk:{i}" for i in range(len(one))]
    assert all(r.chunk_len <= 128 - 10 - 2 and r.parent_start <= r.child_start < r.child_end <= r.parent_end for r in one)
    assert one[0].child_start == 0 and all(a.child_end == b.child_start for a, b in zip(one, one[1:]))
    assert [r.chunk_len for r in out if r.doc_id == "4"] == [225]


def test_parent_chunks_merge_or_drop_the_rest(spark):
    out = C.parent_chunks(docs(spark, [(1, "", TEXT), (2, "", "tiny text."), (3, "", ("y" * 399 + ". ") * 2 + "z" * 700 + ". end it here.")])).collect()
    assert not [r for r in out if r.doc_id == "2"]
    assert all(r.token_count >= 50 for r in out)
    third = [r for r in out if r.doc_id == "3"]
    assert [(r.start_char, r.end_char) for r in third] == [(0, 802), (802, 802 + 702 + 12)] and third[1].token_count == 175 + 3


def test_token_windows(spark):
    rng = random.Random(2)
    for n in (0, 5, 100, 126, 127, 600, 2000):
        stops = [rng.random() < 0.05 for _ in range(n)]
        made = list(C.token_windows(n, stops, 126, 512, 32))
        assert all(b - a <= 126 and c <= a < b <= d for a, b, c, d in made)
        assert all(x[1] == y[0] for x, y in zip(made, made[1:])) and all(d - c >= 400 for _, _, c, d in made[:-1])
        assert not made or made[-1][1] == n or n - made[-1][1] < 32
    df = spark.createDataFrame([(7, 3, list(range(300)))], "doc_id long, title_len int, ids array<int>")
    out = C.token_chunks(df, break_ids=[110]).collect()
    assert [len(r.child_ids) for r in out] == [111, 123, 66] and out[0].chunk_id == "7:chunk:0"


def test_embedding_ids(spark):
    df = spark.createDataFrame([([101, 102], [201, 202, 203]), ([], [1]), (None, [2])], "t array<int>, c array<int>")
    got = [r[0] for r in df.select(C.embedding_ids(F.col("t"), F.col("c"), 6)).collect()]
    assert got == [[101, 101, 102, 102, 201, 202], [101, 1, 102], [101, 2, 102]]
    assert [r[0] for r in df.select(C.embedding_ids(F.col("t"), F.col("c"), 9, cls=None)).collect()] == [[101, 102, 201, 202, 203], [1], [2]]


def test_parent_of_child(spark):
    parents = spark.createDataFrame([(f"d:parent:{i}", "d", a, a + 100) for i, a in enumerate((0, 100, 200))], "parent_id string, doc_id string, start_char int, end_char int")
    kids = [(10, 50), (110, 150), (205, 295), (90, 110), (95, 150), (400, 500)]
    children = spark.createDataFrame([(str(i), "d", a, b) for i, (a, b) in enumerate(kids)] + [("x", "other", 0, 9)], "chunk_id string, doc_id string, child_start int, child_end int")
    out = {r.chunk_id: (r.parent_idx, r.contained) for r in C.parent_of_child(children, parents).collect()}
    assert out == {"0": (0, True), "1": (1, True), "2": (2, True), "3": (0, False), "4": (1, False), "5": (-1, False), "x": (-1, False)}


def test_slices_of_unknown_documents(spark):
    chunks = spark.createDataFrame([("1:chunk:0", "1", "T", 2, 5, 0, 9), ("9:chunk:0", "9", "", 0, 5, 0, 9)], "chunk_id string, doc_id string, title string, child_start int, child_end int, parent_start int, parent_end int")
    out = {r.chunk_id: r for r in C.slices(chunks, docs(spark, [(1, "", "abéde fghi")])).collect()}
    assert out["1:chunk:0"].child_text == "éde" and out["1:chunk:0"].parent_text == "T\n\nabéde fgh" and out["1:chunk:0"].embedding_text == "T\n\néde"
    assert out["9:chunk:0"].child_text == out["9:chunk:0"].parent_text == ""


def test_global_index_is_dense(spark):
    parents = C.parent_chunks(docs(spark, [(i, "", TEXT) for i in range(25)]))
    out = C.with_global_index(parents).orderBy("parent_chunk_idx").collect()
    assert [r.parent_chunk_idx for r in out] == list(range(len(out)))
    assert [(r.doc_id, int(r.parent_id.split(":")[-1])) for r in out] == sorted((r.doc_id, int(r.parent_id.split(":")[-1])) for r in out)


def test_another_splitter(spark):
    halves = lambda text: C.located([text[:40], "not there", text[40:]], text)
    text = "a" * 60 + " " + "b" * 30
    assert C.located(["ab", "x", "ab "], "ab ab") == [("ab", 0, 2), ("ab", 3, 5)]
    (r,) = C.child_chunks(docs(spark, [(1, "", text)]), split=halves).collect()
    assert (r.child_start, r.child_end) == (0, 91)
