import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.functions import models
from corvane.operators import chunking
from corvane.streaming import index_builder


def breaking(flag: str):
    """An encoder that fails at texts with a sign, as long as a file stands there."""

    class Breaks(models.LetterEncoder):
        def encode(self, texts):
            import os

            if os.path.exists(flag) and any("stop here" in t for t in texts):
                raise RuntimeError("broken off")
            return super().encode(texts)

    return Breaks


@pytest.fixture(scope="module")
def chunks(spark, tmp_path_factory):
    docs = spark.createDataFrame([(str(i), f"T{i}", f"Sentence of text number {i} that says more. " * 20 + ("stop here. " * 6 if i == 7 else "")) for i in range(12)], "doc_id string, title string, text string")
    source = str(tmp_path_factory.mktemp("chunks") / "c")
    made = chunking.child_chunks(docs).cache()
    for i in range(12):  # a file a document, so their order is known
        made.where(F.col("doc_id") == str(i)).coalesce(1).write.mode("append").parquet(source)
    return docs, made, source


def values(df):
    return {r.chunk_id: np.round(r.embedding, 3).tolist() for r in df.collect()}


@pytest.mark.parametrize("kind", ["flat", "half"])
def test_a_build_that_was_broken_off_goes_on(spark, chunks, tmp_path, kind):
    docs, made, source = chunks
    flag, told = tmp_path / "flag", []
    flag.write_text("")
    run = lambda: index_builder.build(spark, source, made.schema, docs, breaking(str(flag)), str(tmp_path / "i"), str(tmp_path / "c"), files=2, kind=kind, report=lambda n, m: told.append((n, m)))
    with pytest.raises(Exception, match="broken off"):
        run()
    before = len(told)
    assert 0 < before < 6 and 0 < index_builder.stored_keys(spark, str(tmp_path / "i"), before).count() < made.count()
    flag.unlink()
    out = run()
    assert [n for n, _ in told] == [*range(6)] and sum(m for _, m in told) == made.count() == out.count()
    whole = index_builder.build(spark, source, made.schema, docs, models.LetterEncoder, str(tmp_path / "j"), str(tmp_path / "d"), files=100, kind=kind)
    assert values(out) == values(whole)
    assert values(run()) == values(whole) and len(told) == 6  # nothing left to do


def test_new_files_and_chunks_that_come_again(spark, chunks, tmp_path):
    docs, made, _ = chunks
    source = str(tmp_path / "s")
    run = lambda: index_builder.build(spark, source, made.schema, docs, models.LetterEncoder, str(tmp_path / "i"), str(tmp_path / "c"))
    made.where("doc_id < '5'").write.parquet(source)
    n = run().count()
    made.union(made).write.mode("append").parquet(source)
    out = run()
    assert 0 < n < out.count() == made.count() == out.select("chunk_id").distinct().count()
