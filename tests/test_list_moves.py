"""What the steps of the lists move and parse: no more than they need."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from constella.functions.ranking import numbered_parts, ranked_within
from constella.sources import selection as S
from constella.sources.derive import selection_rows
from tests.test_list_parts import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lookup(spark):
    return spark.createDataFrame([("AA", "0000002", "L2")], "index_name string, internal_key string, isin string")


def test_scan_read_once_is_a_copy_and_equal(spark, tmp_path):
    S.write_csv_lists(rows(spark, 6, 'a;"b"'), str(tmp_path))
    once, plain = S.read_csv_lists(spark, str(tmp_path), once=True), S.read_csv_lists(spark, str(tmp_path))
    assert "Scan csv" not in plan_of(once) and "FileScan csv" in plan_of(plain)
    assert sorted(map(str, once.drop("_mid").collect())) == sorted(map(str, plain.drop("_mid").collect()))


def test_only_rows_without_isin_meet_the_lookup(spark, tmp_path):
    texts = F.when(F.col("ordinal") == 2, " null").when(F.col("ordinal") == 3, "").otherwise(F.col("isin"))
    S.write_csv_lists(rows(spark, 4, names=("AA",)).withColumn("raw_isin", texts), str(tmp_path))
    out = S.normalise_csv_lists(S.read_csv_lists(spark, str(tmp_path), once=True), lookup(spark))
    assert {r.internal_key: r.isin for r in out.collect()} == {
        "0000001": "X00000000001", "0000002": "L2", "0000003": "KEY_0000003", "0000004": "X00000000004"}
    assert "Union" in plan_of(out)


def test_computed_last_order_column_is_not_staged(spark):
    df = spark.createDataFrame([("a", 1, k) for k in (10, 9, 2)], "g string, v int, k long")
    text = F.concat(F.lit("K"), F.lpad(F.col("k").cast("string"), 3, "0"))
    assert numbered_parts(df, ["g"], ["v"], text).columns == ["g", "v", "k", "_at"]
    got = ranked_within(df, ["g"], ["v"], "n", text).collect()
    assert {r.k: r.n for r in got} == {2: 1, 9: 2, 10: 3}


def test_list_rows_are_not_sorted_to_meet_their_instruments(spark):
    entries = rows(spark, 3).select("index_name", "review_date", "isin", "ric", "ff_mcap", "rank", "comment", "ordinal")
    assets = rows(spark, 3).select("index_name", "isin", "internal_key", "ric", "name", "country", "currency", "sedol")
    out = selection_rows(entries, assets)
    assert "ShuffledHashJoin" in plan_of(out) and out.count() == 6


def test_lists_of_one_name_lie_apart_within(spark, tmp_path):
    both = rows(spark, 2, names=("AA",)).withColumn("copy", F.explode(F.array(F.lit("a"), F.lit("b"))))
    S.write_csv_lists(both, str(tmp_path), within=("copy",))
    assert len(glob.glob(f"{tmp_path}/copy=*/index_name=AA/file=*/part=0/*.csv")) == 2
    got = S.read_lists(spark, str(tmp_path)).rows
    assert got.count() == 4 and got.select("_path").distinct().count() == 2
    assert [tuple(r) for r in got.select("review_date").distinct().collect()] == [(dt.date(2001, 4, 1),)]


def test_header_lines_are_found_by_text(spark, tmp_path):
    folder = tmp_path / "index_name=AA" / "file=x.pdf"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join([
        '{"page": 1, "row": 1, "cells": ["has lines"]}', "broken lines {",
        '{"\\u006cines": ["Last updated 20010401"]}', '{"lines": ["Last Updated: 2.4.2001"]}']))
    _, lines = S.read_legacy_reports(spark, str(tmp_path))
    assert sorted(r.lines[0] for r in lines.collect()) == ["Last Updated: 2.4.2001", "Last updated 20010401"]
    assert "FileScan json" not in plan_of(lines)
