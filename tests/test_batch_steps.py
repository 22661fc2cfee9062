"""Steps of an incremental batch: leading rows only, one pass over the assets, report rows named by their file."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from constella.operators import membership as M
from constella.operators import resolve as X
from constella.operators.intervals import first_per_key, merge_listed, merge_snapshots
from constella.operators.ranking import member_ranks
from constella.schemas import IndexRule
from constella.sources import selection as S

RULES = {"A": IndexRule(auto=3, target=4, buffer_end=6, check_to=2), "B": IndexRule(auto=5, target=6, buffer_end=9, check_to=2)}
DAYS = [dt.date(2000, 1, 1), dt.date(2000, 4, 1)]
ENTRY = "index_name string, review_date date, isin string, rank int, ordinal long, file string"


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def check_leading(spark, data):
    entries = spark.createDataFrame(data, ENTRY)
    found = M.leading_first(entries, RULES)
    assert content(M.candidates(found, RULES, dedupe=False)) == content(M.candidates(entries, RULES))
    return found.count()


def test_leading_rows_give_the_candidates_of_all_rows(spark):
    rnd = random.Random(4)
    data = [(x, day, f"X{rnd.randrange(60)}", rnd.choice([None, *range(-3, 300)]), k, rnd.choice(["f", "g"]))
            for x in "ABC" for day in DAYS for k in range(150)]
    data += [("A", DAYS[0], None, 1, 900, "f"), ("B", dt.date(2001, 1, 1), "X1", 5, 1, "f")]
    check_leading(spark, data)
    long = [("A", DAYS[0], f"Y{k:05d}", k, k, "f") for k in range(1, 20001)]
    assert check_leading(spark, long) < 100  # few of the rows are compared by instrument


def test_more_rows_lead_when_leading_ones_are_second_listings(spark):
    # the first file lists everything in reverse order: all of the second one's rows are second listings
    first = [("A", DAYS[0], f"Y{k:05d}", 5000 - k, k, "f") for k in range(3000)]
    second = [("A", DAYS[0], f"Y{k:05d}", k + 1, k, "g") for k in range(2000)]
    check_leading(spark, first + second)
    check_leading(spark, [("A", DAYS[0], f"Y{k}", 7, k, "f") for k in range(50)])  # one rank for all


ASSET = "index_name string, isin string, internal_key string, ric string, name string, first_listed date, file string, ordinal long"


def test_assets_are_merged_in_one_pass(spark):
    rnd = random.Random(5)
    keys, place = ["index_name", "isin"], ["first_listed", "file", "ordinal"]

    def some(n, known):
        return [(rnd.choice("AB"), f"X{rnd.randrange(40)}", None if k % 7 == 0 else f"{k}", f"R{k % 9}", f"N{k}{known}",
                 rnd.choice(DAYS), rnd.choice("fgh"), k) for k in range(n)]

    listed = spark.createDataFrame(some(200, ""), ASSET)
    known = spark.createDataFrame(some(30, "old"), ASSET).withColumn("entity_id", F.lit("stale"))
    cols = ["internal_key", "ric", "name", *place]
    want = merge_snapshots(known, first_per_key(listed, keys, place, cols), keys)
    got = merge_listed(known, listed, keys, place)
    assert content(got.drop("_spread")) == content(want.select(*[c for c in got.columns if c != "_spread"]))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        assert moves(got) == 1 < moves(want)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    # of one row per ISIN the ids are the same as in general, whether or not the rows carry their number
    answers = [(x, e, i, a) for x in "AB" for e, i, a in [
        *[("isin", f"X{k}", None if k % 5 == 0 else f"E{k}") for k in range(0, 40, 3)],
        *[("ric", f"R{k}", f"F{k}") for k in range(7)], ("ric", "R1", "A"), ("ric", "", "blank")]]
    entities = spark.createDataFrame(answers, "index_name string, endpoint string, id string, alpha_id string")
    one = want.withColumn("ric", F.when(F.col("isin") == "X1", F.lit("")).otherwise(F.col("ric")))
    ids = content(X.enrich_ids(one, entities))
    assert content(X.enrich_ids(one, entities, one_per_isin=True)) == ids
    spread = one.withColumn("_spread", F.xxhash64(*keys))
    out, counts = X.enrich_counted(spread, entities, one_per_isin=True)
    assert content(out) == ids and counts == X.enrich_counted(one, entities)[1]
    assert {c > 0 for c in counts.values()} == {True}


def test_ranks_look_up_members_only(spark):
    entries = spark.createDataFrame([("A", DAYS[0], f"X{k}", None if k % 2 else f"R{k}", k, k) for k in range(1, 9)],
                                    "index_name string, review_date date, isin string, ric string, rank int, ordinal long")
    members = entries.where("rank < 5").withColumn("is_member", F.lit(True))
    assets = spark.createDataFrame([("A", f"X{k}", f"S{k}{x}") for k in range(1, 9) for x in "ba"],
                                   "index_name string, isin string, ric string")
    assert {(r.ric, r["rank"]) for r in member_ranks(entries, members, assets).collect()} == {
        ("S1a", 1), ("R2", 2), ("S3a", 3), ("R4", 4)}


def test_report_rows_take_their_names_from_their_file(spark, tmp_path):
    for name, month in (("A", "1"), ("b ü;#%20", "4")):  # a folder whose path is written by escapes
        folder = tmp_path / f"index_name={name}" / "file=sl 1%.pdf"
        folder.mkdir(parents=True)
        (folder / "x.json").write_text("\n".join(json.dumps(x) for x in [
            {"lines": ["lines", f"Last updated 2000010{month}"]}, {"page": 1, "row": 0, "cells": ["ISIN", "Rank (final)"]},
            {"page": 1, "row": 1, "cells": ["lines", "1"]}, {"page": 1, "row": 2, "cells": ["Y", "2"]}]))
    tables, lines = S.read_legacy_reports(spark, str(tmp_path))
    rows = tables.collect()
    at = {(r["index_name"], r["file"]) for r in rows}
    assert len(rows) == 6 and {i[0] for i, _ in at} == {"A", "b"} and len(at) == 2
    for path, index, file in {(r["_path"], r["index_name"], r["file"]) for r in rows}:
        assert f"/index_name={index}/file={file}/" in path
    assert {(r["index_name"], r["file"]) for r in lines.collect()} == at and lines.count() == 2
    assert {r["review_date"].day for r in S.normalise_legacy_reports(tables, lines).collect()} == {1, 4}
    listed = {S._as_metadata(p) for p in spark.read.text([str(p) for p in tmp_path.rglob("*.json")]).inputFiles()}
    assert listed == {r[0] for r in spark.read.option("recursiveFileLookup", True).text(str(tmp_path)).select(
        "_metadata.file_path").distinct().collect()}
