"""Every registered query with SQL gives the same rows in DuckDB, over the smallest tables."""

import os

import duckdb
import pytest

from marginalia.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def text(v):
    return "null" if v is None else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    names = sorted(df.columns)
    rows = sorted(tuple(text(r[c]) for c in names) for r in df.collect())
    if name not in registry.oracle_sql():
        assert rows
        return
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == names
    place = [rel.columns.index(c) for c in names]
    assert rows == sorted(tuple(text(r[i]) for i in place) for r in rel.fetchall())
