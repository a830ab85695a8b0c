"""Every registered query against its oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry_points
from scrimlens.plans import registry

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def _oracle(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def oracle():
    return _oracle(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def _check(spark, con, folder, name):
    df = entry_points.queries()[name](spark, folder)
    columns = sorted(df.columns)
    result = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in places)) for row in result.fetchall())
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    _check(spark, oracle, SF_DIR, name)


#: Queries whose labels are decided by comparing means: more rows meet the borders, and threads add them in another order.
DECIDING = ["window_trends", "window_trends_by_customer", "trend_overview", "outcome_split", "peer_priorities", "pool_trends"]


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="driver tables are not here")
@pytest.mark.parametrize("threads", [1, 8])
@pytest.mark.parametrize("name", DECIDING)
def test_decisions_on_more_rows(spark, name, threads):
    con = _oracle(LARGER)
    con.execute(f"set threads to {threads}")
    spark.conf.set("spark.sql.shuffle.partitions", "1" if threads == 1 else "40")
    try:
        _check(spark, con, LARGER, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
