"""Every registered corpus query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from scholarium.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0 if math.isfinite(value) else str(value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_oracles_rows(spark, duck, name):
    found = QUERIES[name](spark, DATA)
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted_rows(found.columns, found.collect()) == sorted_rows(columns, expected.fetchall())


def test_queries_without_oracle_have_rows(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, DATA).count() > 0
