"""Every query with SQL gives the SQL's rows, on the smallest tables."""

import math
import os

import duckdb
import pytest

from endweave.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = registry.oracle_sql()
#: Queries without SQL that find no gene with two sites in the smallest tables.
FEW = ("dm_usage", "exon_usage_lrt", "exon_usage_contrasts", "dm_usage_audit")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) or type(value).__name__ == "Decimal":
        return float(f"{float(value):.9g}")
    return value


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = [tuple(map(plain, r)) for r in df.select(*cols).collect()]
    res = duck.execute(SQL[name])
    names = [c[0] for c in res.description]
    want = [tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()]
    assert sorted(names) == cols
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_rows_only(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    assert df.columns and (df.count() > 0 or name in FEW)
