"""Each query with SQL beside DuckDB, at the smallest scale."""

import math
import os

import duckdb
import pytest

from larkspur.plans import queries as Q

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, db, name):
    df = Q.QUERIES[name](spark, DATA)
    if name not in Q.ORACLES:
        assert df.count() >= 0
        return
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = db.execute(Q.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = sorted(range(len(names)), key=names.__getitem__)
    assert found == sorted((tuple(plain(r[k]) for k in order) for r in cursor.fetchall()), key=repr)
