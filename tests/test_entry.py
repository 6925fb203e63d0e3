import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_the_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_the_rest_stands_without_the_training_operators(tmp_path):
    """In a copy without the subpackage and the pipeline, and in one where the subpackage lacks what it needs."""
    import shutil
    import subprocess
    import sys

    root = Path(entry.__file__).parent
    for broken in (False, True):
        copy = tmp_path / str(broken)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__"))
        if broken and (copy / "corvane/llm").exists():
            (copy / "corvane/llm/common.py").write_text("import a_package_that_is_not_there\n")
        else:
            shutil.rmtree(copy / "corvane/llm", ignore_errors=True)
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.engine.QUERIES) and len(e.oracle_sql()) > 80"
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={"PATH": "/usr/bin:/bin"} | {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.engine.ORACLE_SQL))
def test_queries_agree_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS FROM '{path + '/*' if os.path.isdir(path) else path}'")
    got = entry.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    rows = [tuple(r[names.index(c)] for c in columns) for r in want.fetchall()]
    show = lambda rs: sorted(tuple(f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rs)
    assert show(rows) == show([tuple(r[c] for c in columns) for r in got.collect()])
