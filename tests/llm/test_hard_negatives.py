import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import hard_negatives


def brute(rows, every=50, positives=5, negatives=3):
    """From (id, vector, label): the contract, pair by pair, in whole numbers."""
    last = 1 << 70
    ok = [(i, [int(np.floor(256 * x)) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (-r[0], last if r[1] is None else r[1])
    out = []
    for a, (i, v, y) in enumerate(ok):
        if i is None or i % every:
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, z == y, b) for b, (j, w, z) in enumerate(ok) if b != a and len(w) == len(v)]
        for p, j, _, _ in sorted((s for s in scored if s[2]), key=key)[:positives]:
            window = [s for s in scored if not s[2] and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(i, j, r, s[1], p, s[0]) for r, s in enumerate(sorted(window, key=key)[:negatives], 1)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    wide = [(i, v, y, "x", 1.0, 7) for i, v, y in rows]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int, row string, norm double, id int").repartition(3)
    return sorted(map(tuple, hard_negatives.mine_hard_negatives(df, **options).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    """Vectors around few points, with large and small norms, exact copies, ties, repeated ids, null and bad components and other widths."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(6, 8))
    out = [(i, (points[i % 6] * rng.choice((0.2, 1, 3)) + rng.normal(size=8) * 0.3).tolist(), int(rng.integers(0, 3))) for i in range(500)]
    out += [(500 + i, out[3][1], i % 3) for i in range(120)]  # copies in all labels
    out += [(50, out[9][1], 1), (50, out[9][1], 2), (None, out[4][1], 0), (-50, out[7][1], 1), (-100, [0.0] * 8, 2)]
    out += [(700, None, 1), (750, [None] * 8, 1), (800, [float("nan")] * 8, 1), (850, [float("inf")] * 8, 1), (900, out[1][1], None)]
    out += [(950, [1.0, 2.0], 0), (951, [1.0, 1.9], 0), (952, [0.9, 1.3], 1), (1000, [], 0), (1001, [], 0), (1002, [], 1)]
    return out


def test_as_brute_force(spark, rows):
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("options", [{"bucket_rows": 7}, {"bucket_rows": 64, "block_rows": 3}, {"every": 7, "positives": 2, "negatives": 10}])
def test_sizes_of_buckets_and_blocks_do_not_matter(spark, rows, options):
    named = {k: v for k, v in options.items() if k in ("every", "positives", "negatives")}
    assert found(spark, rows, **options) == brute(rows, **named)


def test_wide_vectors_make_buckets_and_blocks_smaller(spark, rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_BYTES", 8 * 8 * 5)  # five rows of eight
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 8 * 8 * 6)
    assert found(spark, rows[:300]) == brute(rows[:300])


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * 1e6 + 3e6).tolist(), i % 2) for i in range(60)]
    assert found(spark, rows, every=10) == brute(rows, every=10)
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(i, [1e15, 1e15], i % 2) for i in range(4)], every=2)


def test_empty_tables_and_a_label_from_other_columns(spark, rows):
    assert found(spark, []) == [] == found(spark, [(1, [1.0], 0), (2, [1.0], 1)])
    df = spark.createDataFrame([(i, v, y) for i, v, y in rows], "vec_id long, embedding array<double>, label int")
    moved = hard_negatives.mine_hard_negatives(df, label_col=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    assert sorted(map(tuple, moved.collect()), key=str) == brute([(i, v, (y + 1) % 10 if y is not None and i is not None and i % 7 == 0 else y) for i, v, y in rows])


def test_buckets_below_the_bound_are_not_multiplied(monkeypatch):
    """A bucket of small norms is passed over once larger ones have filled the windows."""
    calls = []
    monkeypatch.setattr(hard_negatives, "products", lambda a, b: calls.append(len(b)) or a @ b.T)
    bucket = lambda number, size, norm: (number, 2, norm, np.arange(size).tobytes(), np.zeros(size, np.int64).tobytes(), (np.ones((size, 2), np.int32) * int(norm)).tobytes())
    one = np.array([1.0, 1.0])
    asked = hard_negatives.Windows(np.array([99]), np.array([9]), np.array([0]), np.array([2]), [one.tobytes()], np.array([0, 1]), np.array([-np.inf]), np.array([None]), None, 3, True)
    got = list(hard_negatives.search(asked, iter([bucket(1, 5, 100.0), bucket(2, 6, 10.0)])))
    assert [g[3] for g in got] == [200, 200, 200] and calls == [5]
