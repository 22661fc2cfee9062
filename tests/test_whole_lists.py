"""The list queries over all reviews hold every list row and file, on both sides of the date cut."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
CUT = dt.date(1999, 12, 1)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def listed(con):
    """Index, review and instrument of every list row, counted from the base tables alone."""
    return set(con.execute("""
        SELECT 'CUST', CAST(date_trunc('quarter', o_orderdate) AS DATE), o_custkey
        FROM orders JOIN customer ON o_custkey = c_custkey
        UNION SELECT 'PART', CAST(date_trunc('quarter', l_shipdate) AS DATE), l_partkey
        FROM lineitem JOIN part ON l_partkey = p_partkey""").fetchall())


def test_every_list_row_is_read(spark, listed):
    rows = entry.queries()["sel_normalise_whole"](spark, SF).collect()
    assert {(r.index_name, r.review_date, int(r.internal_key)) for r in rows} == listed and len(rows) == len(listed)
    assert {r.review_date < CUT for r in rows} == {True, False}


def test_every_list_file_is_read(spark, listed):
    reviews = {(index, date) for index, date, _ in listed}
    dates = entry.queries()["header_dates_whole"](spark, SF).collect()
    assert {(r.index_name, r.review_date) for r in dates} == reviews and len(dates) == len(reviews)
    assert entry.queries()["dq_review_date_whole"](spark, SF).count() == len(reviews)


@pytest.mark.parametrize("name", ["sel_normalise", "sel_assets", "dq_review_date", "sel_normalise_legacy",
                                  "header_dates", "norm_names"])
def test_whole_query_matches_sql(spark, con, name):
    df = entry.queries()[f"{name}_whole"](spark, SF)
    cur = con.execute(entry.oracle_sql()[f"{name}_whole"])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, cur.fetchall())[0]
