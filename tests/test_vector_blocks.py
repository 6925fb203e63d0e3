import random

import numpy as np
import pytest

from corvane.operators import pivots, ranking
from corvane.sources import vector_blocks
from corvane.sources.indexes import IndexSet


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors around 40 points, one of which holds a third, with exact copies, other widths, nulls and empty vectors."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(40, 12)) * 3
    at = np.where(rng.random(2000) < 0.33, 0, rng.integers(0, 40, 2000))
    v = points[at] + rng.normal(size=(2000, 12)) * 0.05
    rows = [(f"v{i:04}", x.tolist()) for i, x in enumerate(v)] + [(f"c{i}", v[7].tolist()) for i in range(50)] + [("w", [1.0] * 5), ("n", None), ("e", []), ("h", [None] + [0.5] * 11)]
    random.Random(1).shuffle(rows)
    queries = [(i, (points[i] * 0.7).tolist()) for i in range(15)] + [(20, v[7].tolist()), (21, [0.0] * 12), (22, None), (23, [1.0, 2.0])]
    return spark.createDataFrame(rows, "chunk_id string, embedding array<float>").repartition(5), spark.createDataFrame(queries, "query_id int, embedding array<float>")


def shown(df):
    return sorted((r.query_id, r.dense_rank, r.chunk_id, round(r.similarity, 6)) for r in df.collect())


@pytest.mark.parametrize(("rows", "k", "probes"), [(32, 5, 2), (64, 60, 1), (1000, 3, 4)])
def test_pivots_give_what_the_whole_scan_gives(spark, tmp_path, clustered, rows, k, probes):
    vectors, queries = clustered
    pivots.blocks_around_centres(vectors, rows=rows).write.parquet(str(tmp_path / "b"))
    blocks = spark.read.parquet(str(tmp_path / "b"))
    known = vectors.selectExpr("chunk_id", "transform(embedding, x -> coalesce(x, 0f)) as embedding")
    assert shown(pivots.search(queries, blocks, k, probes=probes)) == shown(ranking.dense_topk(queries, known, k))
    assert shown(pivots.search(queries, blocks, k, probes=probes, block_bytes=400)) == shown(ranking.dense_topk(queries, known, k))
    share = pivots.share_read(queries, blocks, k, probes=probes).first()
    assert 0 < share.pairs_read <= share.pairs
    if rows == 32:
        assert share.share < 0.35


def test_empty_tables(spark, tmp_path, clustered):
    vectors, queries = clustered
    pivots.blocks_around_centres(vectors.limit(0)).write.parquet(str(tmp_path / "b"))
    assert pivots.search(queries, spark.read.parquet(str(tmp_path / "b")), 3).count() == 0
    pivots.blocks_around_centres(vectors).write.parquet(str(tmp_path / "c"))
    assert pivots.search(queries.limit(0), spark.read.parquet(str(tmp_path / "c")), 3).count() == 0


def test_half_blocks_take_half_the_bytes_and_come_back(spark, tmp_path):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(5000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "chunk_id long, embedding array<float>").coalesce(1)
    size = lambda p: sum(f.stat().st_size for f in p.rglob("*.parquet"))
    flat, half = IndexSet({"a": str(tmp_path / "flat")}), IndexSet({"a": str(tmp_path / "half")}, kind="half")
    for index in (flat, half):
        index.save("a", df)
    assert size(tmp_path / "half") < 0.56 * size(tmp_path / "flat")
    back = {r.chunk_id: r.embedding for r in half.load(spark, "a").collect()}
    assert len(back) == 5000 and all(np.array_equal(np.array(back[i], np.float16), v[i].astype(np.float16)) for i in range(5000))
    assert sorted(r.chunk_id for r in half.keys(spark, "a").collect()) == list(range(5000))
    (row,) = vector_blocks.packed(df.where("chunk_id = 3"), kind="half").collect()
    assert row.radius == 0 and len(row.vectors) == 128
