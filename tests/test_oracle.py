"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import pathlib
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL_SF
from tools.compare_oracle import TABLES, rows_of
from tributary.plans import catalog, oracle

QUERIES = catalog.queries()
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SMALL_SF}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_works_without_the_corpus_operators(tmp_path):
    """The corpus operators and the pipeline can be taken out of the repository."""
    root = pathlib.Path(entry.__file__).parent
    corpus = ("corpus_pipeline.py", "llm")
    shutil.copytree(
        root, tmp_path / "repo", ignore=lambda _, names: [n for n in names if n in corpus or n.startswith((".", "__pycache__"))]
    )
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q)); assert set(e.oracle_sql()) == set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) == len(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "event_date", "event_hour", "events"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in PYTHON_NODES:
        assert node not in plan, f"{name} plan contains {node}"
    spark_rows, spark_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    duck_rows, duck_cols = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert spark_cols == duck_cols
    assert len(spark_rows) == len(duck_rows)
    assert spark_rows == duck_rows
