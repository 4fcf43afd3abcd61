"""Every registered query against its SQL oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(E.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    q = "SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({E.oracle_sql()[name]})"
    want = sorted((tuple(_norm(v) for v in row) for row in con.sql(q).fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["observation_description", "avg_value", "value_unit", "sample_size"]
