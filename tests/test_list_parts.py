"""Lists written in several parts, and files read in several splits, come back as one list each."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from constella.sources import selection as S

FIELDS = ("index_name string, review_date date, ordinal long, internal_key string, raw_isin string, isin string, "
          "ric string, name string, country string, currency string, sedol string, ff_mcap double, rank int, "
          "comment string")


def rows(spark, n, comment=None, names=("AA", "BB")):
    day = dt.date(2001, 4, 1)
    return spark.createDataFrame(
        [(x, day, k, f"{k:07d}", f"X{k:011d}", f"X{k:011d}", f"{k}.X", f"N{k}", "C", "EUR", "S", 1.5 * k, k, comment)
         for x in names for k in range(1, n + 1)], FIELDS)


def parts(path, suffix):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(suffix))


@pytest.mark.parametrize("comment", [None, 'one\n"two"; three'])
def test_parts_of_a_csv_list_are_one_list(spark, tmp_path, monkeypatch, comment):
    monkeypatch.setattr(S, "PART_ROWS", 3)
    S.write_csv_lists(rows(spark, 8, comment), str(tmp_path))
    assert len(parts(tmp_path, ".csv")) == 6
    lists = S.read_lists(spark, str(tmp_path))
    got = lists.rows.orderBy("index_name", "ordinal").collect()
    assert [(r.index_name, r.ordinal, r["rank"], r.isin, r.comment) for r in got] == [
        (x, k, k, f"X{k:011d}", comment) for x in ("AA", "BB") for k in range(1, 9)]
    assert len({r["_path"] for r in got}) == 2
    assert {(r.review_date, r.dates) for r in lists.dates.collect()} == {(dt.date(2001, 4, 1), 1)}
    assert lists.dates.count() == 2 and lists.rejects.count() == 0


def test_the_first_row_of_the_first_part_gives_the_date(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 3)
    S.write_csv_lists(rows(spark, 8, names=("AA",)), str(tmp_path))
    late = S.read_csv_lists(spark, str(tmp_path)).withColumn(
        "creation_date", F.when(F.col("_place") > 1, "20020101").otherwise(F.col("creation_date")))
    assert {r.review_date for r in S.normalise_csv_lists(late, None).collect()} == {dt.date(2001, 4, 1)}
    bad = S.csv_rejects(late.withColumn("rank_final", F.when(F.col("_place") == 7, "x").otherwise(F.col("rank_final"))))
    assert [(r.ordinal, r.reason, r.value) for r in bad.collect()] == [(7, "rank", "x")]


def test_places_do_not_depend_on_splits(spark, tmp_path):
    S.write_csv_lists(rows(spark, 200, names=("AA",)), str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scan = S.read_csv_lists(spark, str(tmp_path))
        assert scan.select("_block").distinct().count() > 3
        got = S.read_lists(spark, str(tmp_path)).rows.orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.ordinal, r["rank"]) for r in got] == [(k, k) for k in range(1, 201)]


def test_parts_of_a_report_are_one_report(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 4)
    S.write_legacy_reports(rows(spark, 9).where("ordinal != 3"), str(tmp_path), page_size=2)
    assert len(parts(tmp_path, ".json")) == 6
    tables, lines = S.read_legacy_reports(spark, str(tmp_path))
    assert lines.count() == 2
    places = [(r.page, r.row) for r in tables.where("index_name = 'AA'").orderBy("page", "row").collect()]
    assert places == [(1, 0), (1, 1), (1, 2), (1, 999), (2, 2), (2, 999), (3, 1), (3, 2), (3, 999), (4, 1), (4, 2),
                      (4, 999), (5, 1), (5, 999)]
    got = S.normalise_legacy_reports(tables, lines).where("index_name = 'BB'").orderBy("ordinal").collect()
    assert [(r["rank"], r.ff_mcap, r.review_date) for r in got] == [
        (k, 1.5 * k, dt.date(2001, 4, 1)) for k in (1, 2, 4, 5, 6, 7, 8, 9)]
    assert len({r["_path"] for r in got}) == 1


def test_no_list_row_is_moved_to_find_its_header_or_date(spark, tmp_path):
    S.write_csv_lists(rows(spark, 5), str(tmp_path))
    out = S.normalise_csv_lists(S.read_csv_lists(spark, str(tmp_path)), None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan


def test_dates_by_digits_equal_dates_by_pattern(spark):
    texts = ["20010401", " 20010401 ", "20010230", "00000101", "2001-04-01", "2001041", "200104011", "", None, "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(S._day(F.col("t")).cast("string"), F.try_to_date(F.trim("t"), "yyyyMMdd").cast("string")).collect()
    assert all(a == b for a, b in got) and got[0][0] == "2001-04-01"
