"""Every registered query against its DuckDB oracle on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from ticksmith.plans.oracle import ORACLE
from ticksmith.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "pages"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v if v is None or isinstance(v, (int, bool)) else str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "symbol" and df.count() > 0


def test_every_query_has_oracle_or_reason():
    assert not set(QUERIES) - set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
