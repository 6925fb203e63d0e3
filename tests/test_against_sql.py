"""Queries against their SQL on tables that the given ones do not hold."""

import duckdb

import __spark_entry__ as entry


def shown(rows):
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)


def both(spark, name, folder, *tables):
    """(rows of the query, rows of its SQL), in the SQL's order of columns."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = entry.queries()[name](spark, str(folder)).select(*columns).collect()
    return shown(map(tuple, got)), shown(want.fetchall())


def test_detected_columns_with_blank_and_null_values(spark, tmp_path):
    values = (None, "", " ", " x ", "\n")
    rows = [(i, values[i % 5], values[i // 5 % 5], values[i // 25]) for i in range(125)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got, want = both(spark, "detected_columns", tmp_path, "documents")
    assert got == want and len(got) == 125


def test_cosine_in_group_asks_for_every_vector(spark, tmp_path):
    """Also in a group without a multiple of 20, with copies of a vector, and with no group at all."""
    rows = [(i, [float(i % 3), float(i % 7), 0.1], None if i % 11 == 0 else i % 4) for i in range(60)] + [(100 + i, [1.0, 0.0, 0.0], 9) for i in range(12)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got, want = both(spark, "cosine_in_group", tmp_path, "embeddings")
    assert got == want and {int(r[0]) for r in got} == {r[0] for r in rows if r[2] is not None}


def test_bounds_of_wide_tables_keep_ties_in_order():
    import numpy as np

    from corvane.operators import ranking

    rng = np.random.default_rng(3)
    s = rng.integers(0, 40, (50, 700)).astype(float)
    s[0], s[1, ::2], s[2, 5] = 1.0, np.nan, np.inf
    rows, cols = ranking._largest(s, np.full(50, -np.inf), 5)
    for i, x in enumerate(s):
        assert list(cols[rows == i]) == sorted((j for j in range(700) if np.isfinite(x[j])), key=lambda j: (-x[j], j))[:5]
