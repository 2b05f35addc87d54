"""Queries with SQL give the SQL's rows, on the smallest tables."""

import os

import duckdb
import pytest

from endweave.llm import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    res = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in res.description]
    want = [tuple(r[names.index(c)] for c in cols) for r in res.fetchall()]
    assert sorted(names) == cols
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, want))
