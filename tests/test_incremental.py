"""Incremental ingestion: new files only, one-step publishing, replays, both dialects, derived tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from constella.operators import membership as M
from constella.operators import ranking as R
from constella.operators.intervals import extend_intervals, membership_intervals
from constella.plans.book import write_dialects
from constella.schemas import IndexRule
from constella.session import scratch_path
from constella.sources import dataset as D
from constella.sources.dataset import ReviewDataset
from constella.sources.selection import ListError, read_lists, write_csv_lists
from constella.streaming.incremental import ingest_lists, published_lookup, start_list_stream

RULES = {"T": IndexRule(auto=3, target=4, buffer_end=6, check_to=2)}
ORDERS = [list("ABCDEFGH"), list("HGFEDCBA"), list("ABHGCDEF"), list("FEDCBAHG"), list("ACEGBDFH")]
DAYS = [dt.date(1999, 1, 1), dt.date(1999, 7, 1), dt.date(2000, 1, 1), dt.date(2000, 4, 1), dt.date(2000, 7, 1)]
TABLES = ("assets", "entries", "membership", "reviews", "ranks", "intervals", "rejects")


def rows(spark, quarters, blank=()):
    data = []
    for q in quarters:
        for k, name in enumerate(ORDERS[q]):
            data.append(("T", DAYS[q], f"XX{name}", f"{name}.X", f"00{ord(name)}", "" if name in blank else f"XX{name}",
                         f"Name {name}", "DE", "EUR", None, 100.0 - k, k + 1, None, k + 1))
    return spark.createDataFrame(
        data, "index_name string, review_date date, isin string, ric string, internal_key string, raw_isin string, "
              "name string, country string, currency string, sedol string, ff_mcap double, rank int, "
              "comment string, ordinal bigint")


def batch(spark, quarters):
    df = rows(spark, quarters).select("index_name", "review_date", "isin", "ric", "rank", "ordinal")
    members = M.chain_membership(M.candidates(df, RULES), RULES)
    reviews = df.select("index_name", "review_date").distinct()
    return {"membership": members.select("index_name", "review_date", "isin", "is_member", "entry_reason"),
            "intervals": membership_intervals(members, reviews),
            "ranking": R.ranking_on(df, members, reviews.withColumnRenamed("review_date", "date"), "2001-01-01")}


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def check_equals_batch(spark, ds, quarters):
    want, ds = batch(spark, quarters), ds.pinned()
    days = ds.table("reviews").withColumnRenamed("review_date", "date")
    assert content(ds.table("membership")) == content(want["membership"])
    assert content(ds.intervals()) == content(want["intervals"])
    assert content(ds.ranking_on(days, "2001-01-01")) == content(want["ranking"])


def places(ds, table):
    return {(r.index_name, r.review_date): r["commit"] for r in ds.manifest().where(F.col("table") == table).collect()}


def test_waves_and_a_late_list_of_both_dialects(spark):
    src, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ckpt")
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    seen = []
    for quarters in ([0], [1, 2], [4], [3], []):  # reports, both, CSV, a late list, nothing new
        if quarters:
            write_dialects(rows(spark, quarters), src)
        start_list_stream(spark, src, ds, ckpt, RULES)
        seen += quarters
        check_equals_batch(spark, ds, sorted(seen))
    assert ds.latest_version() == 4
    old, new = (places(ReviewDataset(spark, ds.root, v), "membership") for v in (3, 4))
    # the late list changes its own review and the one after it; all others keep their files
    assert {d for (_, d), c in new.items() if old.get(("T", d)) != c} == {DAYS[3], DAYS[4]}
    closed = {d for (_, d), c in places(ReviewDataset(spark, ds.root, 4), "intervals").items()
              if places(ReviewDataset(spark, ds.root, 3), "intervals").get(("T", d)) == c}
    assert all(d < DAYS[2] for d in closed)
    assert ds.table("reviews").count() == 5 and ds.asset_intervals().where("name is null").count() == 0
    assert ReviewDataset(spark, ds.root, 1).table("reviews").count() == 1  # an old version stays readable


def test_missing_isins_come_from_the_published_assets(spark):
    src, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ckpt")
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    for quarters, blank in (([2], "B"), ([3], "AB"), ([4], "ABC")):
        write_dialects(rows(spark, quarters, blank), src)
        start_list_stream(spark, src, ds, ckpt, RULES)
    got = {(r.review_date, r.isin) for r in ds.table("entries").collect()}
    for q, missing in ((2, "B"), (3, "B"), (4, "B")):  # B never had an ISIN; A and C are known when theirs is blank
        assert {i for d, i in got if d == DAYS[q]} == {f"KEY_00{ord(x)}" if x in missing else f"XX{x}" for x in "ABCDEFGH"}
    assert {r.internal_key for r in published_lookup(ds).collect()} == {f"00{ord(x)}" for x in "ACDEFGH"}


def test_a_failed_batch_shows_nothing_and_its_replay_everything(spark, monkeypatch):
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    src = scratch_path(spark, "t-src")
    write_dialects(rows(spark, [0, 2]), src)
    ingest_lists(read_lists(spark, src), ds, RULES, batch=("s", 0))
    before = {t: content(ds.table(t)) for t in TABLES}
    more = scratch_path(spark, "t-more")
    write_dialects(rows(spark, [1, 3]), more)
    lists = read_lists(spark, more, published_lookup(ds))
    real = D._writer
    for broken in ("assets", "membership", "rejects"):
        def fail(df, keys, broken=broken):
            if set(df.columns) == set(before_columns[broken]):
                raise OSError(f"{broken} is lost")
            return real(df, keys)

        before_columns = {t: ds.table(t).columns for t in TABLES}
        monkeypatch.setattr(D, "_writer", fail)
        with pytest.raises(OSError, match="is lost"):
            ingest_lists(lists, ds, RULES, batch=("s", 1))
        monkeypatch.setattr(D, "_writer", real)
        assert ds.latest_version() == 1
        if broken == "rejects":
            assert {t: content(ds.table(t)) for t in TABLES} == before
    reader = ds.pinned()
    first = ingest_lists(lists, ds, RULES, batch=("s", 1))
    assert {t: content(reader.table(t)) for t in TABLES} == before  # a reader keeps its version
    check_equals_batch(spark, ds, [0, 1, 2, 3])
    assert first.last_batch("s") == 1
    again = ingest_lists(lists, ds, RULES, batch=("s", 1))  # the same files once more change nothing
    assert {t: content(again.table(t)) for t in TABLES} == {t: content(first.table(t)) for t in TABLES}


def test_an_unfinished_manifest_is_no_version(spark):
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    src = scratch_path(spark, "t-src")
    write_dialects(rows(spark, [2]), src)
    ingest_lists(read_lists(spark, src), ds, RULES)
    fs, folder = ds._folder("manifest/version=2")
    fs.mkdirs(folder)
    fs.create(ds._folder("manifest/version=2/part-0.parquet")[1]).close()
    assert ds.latest_version() == 1 and ds.table("reviews").count() == 1
    write_dialects(rows(spark, [3]), src)
    ingest_lists(read_lists(spark, src), ds, RULES)
    check_equals_batch(spark, ds, [2, 3])
    with pytest.raises(D.CommitConflict):
        ReviewDataset(spark, ds.root, 1).commit({"reviews": D.Change(ds.table("reviews"))})


def test_a_bad_list_stops_the_batch_before_any_write(spark):
    src, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ckpt")
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    write_csv_lists(rows(spark, [2]), src)
    bad = read_lists(spark, src)
    mixed = bad.dates.withColumn("dates", F.lit(2).cast("long"))
    with pytest.raises(ListError, match="2 review dates"):
        ingest_lists(type(bad)(bad.rows, bad.rejects, mixed), ds, RULES)
    assert ds.latest_version() == 0
    undated = scratch_path(spark, "t-undated")
    spark.createDataFrame([("I", "x.csv", "1;", "X")], "index_name string, file string, a string, b string").write.partitionBy(
        "index_name", "file").option("header", True).option("sep", ";").csv(undated)
    with pytest.raises(Exception, match="no review date"):
        start_list_stream(spark, undated, ds, ckpt, RULES)
    assert ds.latest_version() == 0


def test_same_review_split_over_two_batches(spark):
    src, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ckpt")
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    full = rows(spark, [2])
    # Two files of the same review, arriving in different micro-batches: the
    # second must be added to the published review, not overwrite it.
    write_csv_lists(full.where(F.col("rank") <= 4), src)
    start_list_stream(spark, src, ds, ckpt, RULES)
    write_csv_lists(full.where(F.col("rank") > 4), f"{src}/late")
    start_list_stream(spark, src, ds, ckpt, RULES)
    assert ds.table("entries").count() == 8
    got = sorted((r.isin, r.entry_reason) for r in ds.table("membership").collect())
    assert got == [(f"XX{n}", "bootstrap") for n in sorted(ORDERS[2][:4])]


def test_a_review_without_ranked_rows_is_published(spark):
    ds = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    src = scratch_path(spark, "t-src")
    unranked = rows(spark, [3]).withColumn("rank", F.lit(None).cast("int"))
    write_csv_lists(rows(spark, [2]).unionByName(unranked).unionByName(rows(spark, [4])), src)
    ingest_lists(read_lists(spark, src), ds, RULES)
    reasons = {}
    for r in ds.table("membership").collect():
        reasons.setdefault(r.review_date, set()).add(r.entry_reason)
    assert ds.table("reviews").count() == 3 and set(reasons) == {DAYS[2], DAYS[4]}
    assert "bootstrap" in reasons[DAYS[2]] and "bootstrap" not in reasons[DAYS[4]]
    # a later batch, too, takes the member-less review as prior
    late = ReviewDataset(spark, scratch_path(spark, "t-ds"))
    for part in (rows(spark, [2]), unranked, rows(spark, [4])):
        one = scratch_path(spark, "t-one")
        write_csv_lists(part, one)
        ingest_lists(read_lists(spark, one), late, RULES)
    assert content(late.table("membership")) == content(ds.table("membership"))
    assert content(late.intervals()) == content(ds.intervals())


def test_extended_intervals_equal_recomputed_ones(spark):
    rng = random.Random(8)
    days = [dt.date(2010 + q // 4, 1 + 3 * (q % 4), 1) for q in range(14)]
    held = {(d, f"I{k}") for d in days for k in range(9) if rng.random() < 0.7 and d != days[6]}

    def members(some):
        return spark.createDataFrame([("T", d, i, True) for d, i in sorted(some)],
                                     "index_name string, review_date date, isin string, is_member boolean")

    def calendar(some):
        return spark.createDataFrame([("T", d) for d in some], "index_name string, review_date date")

    for late in (0, 3, 6, 13):
        first = [d for k, d in enumerate(days) if k != late]
        published = membership_intervals(members({x for x in held if x[0] in first}), calendar(first))
        since = calendar([days[late]])
        changed, place = extend_intervals(published, members({x for x in held if x[0] >= days[late]}), calendar(days), since)
        start = place.first().review_date
        kept = published.where(F.col("last_included") < F.lit(start))
        want = membership_intervals(members(held), calendar(days))
        assert content(kept.unionByName(changed)) == content(want)
