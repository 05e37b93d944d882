"""Every registered query against its SQL oracle (sf0.001), as the round
driver compares them: row count, column names and the order-insensitive
multiset of values."""

import duckdb
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL
from lakefold.plans import oracle
from lakefold.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def bag(table):
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return names, sorted(repr(tuple(c[i] for c in cols)) for i in range(table.num_rows))


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toArrow()
    want = duck.sql(SQL[name]).to_arrow_table()
    assert got.num_rows == want.num_rows
    assert bag(got) == bag(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["publish_date", "publisher", "title", "url", "description", "keyword"]
    assert df.count() > 0
