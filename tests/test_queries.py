"""Every registered query against its SQL on the smallest tables, and contract checks."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, open_tables
from tidemark.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def db():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, db, sql) is None


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(oracle_sql()) <= set(queries())


def test_bitmap_never_exceeds_exact(spark):
    exact = {r.window_end: r.n for r in queries()["unique_visitor"](spark, SF).collect()}
    bitmap = {r.window_end: r.n for r in queries()["uv_bitmap"](spark, SF).collect()}
    assert all(bitmap[w] <= exact[w] for w in exact)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "n"]
    assert df.count() > 0
