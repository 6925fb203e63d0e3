import os

import duckdb
import pytest

from corvane.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_agree_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "pages", "conversations"):
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS FROM '{path + '/*' if os.path.isdir(path) else path}'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = [names.index(c) for c in got.columns]
    assert sorted(map(str, (tuple(r[i] for i in order) for r in want.fetchall()))) == sorted(str(tuple(r)) for r in got.collect())
