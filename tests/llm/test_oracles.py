"""Queries with SQL against it, as the round driver compares them."""

import duckdb
import pytest
from conftest import multiset

from lakefold.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, small_sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_sf}/{t}.parquet')")
    got, want = QUERIES[name](spark, small_sf).toArrow(), con.sql(ORACLE_SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    columns = sorted(got.column_names)
    assert multiset(got.select(columns).to_pylist()) == multiset(want.select(columns).to_pylist())
