"""Corpus queries against their DuckDB SQL, on whole tables."""

import os

import duckdb
import pytest

from tests.conftest import MID_SF, SMALL_SF
from tools.compare_oracle import TABLES, rows_of
from tributary.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("sf_dir", [SMALL_SF, MID_SF])
@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    df = queries.queries()[name](spark, sf_dir)
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    assert have == rows_of([c[0] for c in cur.description], cur.fetchall())
