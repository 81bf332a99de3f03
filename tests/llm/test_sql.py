"""The operators that SQL can express, against DuckDB on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from ticksmith.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(r[k] for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, res.fetchall())
