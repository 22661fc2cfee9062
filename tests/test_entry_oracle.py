"""Driver contract and a sample of queries against their SQL twins (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from constella.plans.oracle import ORACLE
from constella.plans.queries import QUERIES
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) >= {"index_name", "country", "members"}


def test_every_query_has_sql_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", [
    "country_top10", "buffer_chain", "buffer_single", "islands", "rank_gaps", "resolve_isin", "enrich_ids",
    "match_publications", "sel_normalise_legacy", "mcap_histogram",
])
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0].lower() for d in cur.description]
    orows = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(ocols)
    assert digest([c.lower() for c in df.columns], srows)[0] == digest(ocols, orows)[0]
