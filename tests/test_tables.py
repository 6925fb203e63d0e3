import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import qa, quality, sampling
from corvane.sources import readers, writers


def test_readers(spark, tmp_path):
    rows = [{"id": "1", "text": "a\nb", "title": "t"}, {"doc_id": "2", "content": "c"}]
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "y.json").write_text(json.dumps(rows))
    (tmp_path / "z.json").write_text(json.dumps({"1": {"text": "a\nb", "title": "t"}, "2": "c"}))
    (tmp_path / "w.csv").write_text('id,text,title\n1,"a\nb",t\n2,"c, ""d""",\n')
    want = [("1", "t", "a\nb"), ("2", "", "c")]
    for name in ("x.jsonl", "y.json", "z.json"):
        assert sorted(map(tuple, readers.read_documents(spark, str(tmp_path / name)).collect())) == want
    assert sorted(map(tuple, readers.read_documents(spark, str(tmp_path / "w.csv")).collect())) == [("1", "t", "a\nb"), ("2", "", 'c, "d"')]
    assert readers.read_documents(spark, str(tmp_path / "x.jsonl"), sample=1).count() == 1
    with pytest.raises(ValueError):
        readers.read_documents(spark, "x.bin")
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "w.csv"), required=["prompt"])


def test_folder_maps_spans_and_kinds(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, text string").coalesce(1).write.parquet(str(tmp_path / "f/one.parquet"))
    (tmp_path / "f/two.csv").write_text("id,extra\n2,e\n")
    assert sorted((r.id, r.text, r.extra) for r in readers.read_folder(spark, str(tmp_path / "f")).collect()) == [(1, "a", None), (2, None, "e")]
    (tmp_path / "l.json").write_text('["a", "b"]')
    (tmp_path / "m.json").write_text('{"0": "a", "1": "b"}')
    for name in ("l.json", "m.json"):
        assert sorted(map(tuple, readers.read_id_map(spark, str(tmp_path / name)).collect())) == [(0, "a"), (1, "b")]
    children = spark.createDataFrame([("d", 0, 7, 9), ("d", 2, 3, 5)], "doc_id string, start_char int, child_start int, end_char int")
    assert [tuple(map(tuple, r.spans)) for r in readers.child_spans(children).collect()] == [((2, 5), (7, 9))]
    (tmp_path / "k").mkdir()
    for name, data in {"a.json": b' {"x": 1}', "b": bytes(range(16)), "c.txt": b"hello", "d": b""}.items():
        (tmp_path / "k" / name).write_bytes(data)
    assert {r.path.rsplit("/", 1)[-1]: r.kind for r in readers.file_kinds(spark, str(tmp_path / "k")).collect()} == {"a.json": "json", "b": "binary", "c.txt": "text"}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc')], "id long, text string")
    writers.write_csv(df, str(tmp_path / "c"), single=True)
    assert readers.read_csv(spark, str(tmp_path / "c"), schema="id long, text string").collect() == df.collect()
    writers.write_parquet(df, str(tmp_path / "p"))
    writers.write_json(df, str(tmp_path / "j"), single=True)
    assert spark.read.parquet(str(tmp_path / "p")).collect() == df.collect() and spark.read.json(str(tmp_path / "j")).count() == 1
    assert writers.without_null_name("a/b.c.csv") == "a/b.c_without_null.csv" and writers.without_null_name("x") == "x_without_null"


def test_answers(spark):
    said = [("<b>A</b> C", "A", "A"), ("<think>D</think>", "D", "D"), ("<C>", "A", "C"), ("none", "A", "B"), (None, "A", "B")]
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(said)], "i int, t string").orderBy("i")
    assert [tuple(r) for r in df.select(qa.parse_answer(F.col("t")), qa.parse_loose(F.col("t"))).collect()] == [s[1:] for s in said]
    rows = spark.createDataFrame([("A", "A"), ("B ", "B"), ("C", "D"), (None, "A"), ("", "E")], "answer string, predicted string")
    assert tuple(qa.accuracy(rows, "answer", "predicted").first()) == (5, 3, 2 / 5, 2 / 3)
    assert qa.error_rows(rows, "answer", "predicted").count() == 4
    assert {r.label: r.n for r in qa.distribution(rows, "answer").collect()} == {"A": 1, "B ": 1, "C": 1, None: 1, "": 1}
    c = spark.createDataFrame([("x", None, " ", "z")], "C1 string, C2 string, C3 string, C4 string")
    assert c.select(qa.context(["C1", "C2", "C3", "C4"])).first()[0] == "[Document 1]\nx\n\n[Document 4]\nz"
    s = spark.createDataFrame([([0.1, 0.5, 0.5, 0.0, 0.2],), ([],)], "s array<double>")
    assert [r[0] for r in s.select(qa.best_letter(F.col("s"))).collect()] == ["B", "A"]
    assert qa.invalid_answers(spark.createDataFrame([("A",), ("x",), (None,)], "predicted string"), "predicted").count() == 2


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "ccc", [1, 2])], "id long, t string, v array<int>")
    assert {r["column"]: (r.non_null, r.nulls) for r in quality.null_profile(df).collect()} == {"id": (3, 0), "t": (2, 1), "v": (1, 2)}
    assert {r["column"]: (r.lowest, r.highest) for r in quality.column_profile(df).collect()} == {"id": (1, 3), "t": (1, 3), "v": (2, 2)}
    kept, counts = quality.drop_null_rows(df)
    assert kept.count() == 1 and tuple(counts.first()) == (3, 1, 2)
    assert {r.id: r.null_columns for r in quality.null_rows(df).collect()} == {1: ["v"], 2: ["t", "v"]}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "k long")
    states = {a: quality.coverage(ids(*m), ids(*c), "k").first() for a, m, c in (("complete", (1, 2), (2, 1)), ("over-indexed", (1, 2), (1,)), ("incomplete", (1,), (1, 2)), ("mismatch", (1, 3), (1, 2)))}
    assert all(r.coverage == name for name, r in states.items()) and (states["mismatch"].missing_samples, states["mismatch"].extra_samples) == ("2", "3")
    assert quality.text_columns(["id", "my_text", "x"]) == ["my_text"] and quality.text_columns(["doc_id", "a", "b", "c", "d"]) == ["a", "b", "c"]
    both = spark.createDataFrame([("", "T", " ", "body")], "title string, name string, text string, content string")
    assert tuple(quality.title_and_text(both).select("__title", "__text").first()) == ("T", "body")
    with pytest.raises(ValueError):
        quality.role_column(["a"], ["b"])


def test_sampling(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3 if i < 30 else 0]) for i in range(50)], "id long, label string")
    out = sampling.stratified_split(df, "label", "id", 11).collect()
    assert len(out) == 50 and sum(r.part == "sample" for r in out) == 11
    assert {x: sum(r.part == "sample" and r.label == x for r in out) for x in "abc"} == {"a": 7, "b": 2, "c": 2}
    with pytest.raises(ValueError):
        sampling.stratified_split(df, "label", "id", 50)
    with pytest.raises(ValueError):
        sampling.union_common(df, spark.createDataFrame([(1,)], "other int"))
    a, b = ([r.id for r in sampling.shuffled(df.repartition(n), "id").collect()] for n in (1, 7))
    assert a == b != sorted(a) and [r.id for r in sampling.sample_rows(df, "id", 5).collect()] == a[:5]


def test_index_sets(spark, tmp_path):
    from corvane.sources.indexes import IndexSet

    v = spark.createDataFrame([("a", [0.1, 2.0]), ("b", [1.0, 3.0])], "chunk_id string, embedding array<float>")
    s = IndexSet({"x": str(tmp_path / "x"), "y": str(tmp_path / "y")}, disabled={"y"}, kind="half")
    s.save("x", v.where("chunk_id = 'a'"))
    s.save("x", v.where("chunk_id = 'b'"))
    got = {r.chunk_id: r.embedding for r in s.load_all(spark)["x"].collect()}
    assert set(got) == {"a", "b"} and abs(got["a"][0] - 0.1) < 1e-3 and got["a"][0] != pytest.approx(0.1, abs=1e-7)
    with pytest.raises(ValueError):
        IndexSet({}, kind="tree")
