"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from basketlens.plans.catalog import QUERIES
from basketlens.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in (x.asDict() for x in df.collect()))
    res = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    exp = Counter(tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in res.fetchall())
    assert got == exp


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["active_customers"] + r["churned_customers"] == r["total_customers"]
