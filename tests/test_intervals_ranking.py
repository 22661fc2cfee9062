"""Membership intervals, exit sentinels, daily ranking and rank checks."""

import datetime as dt

from constella.operators import ranking as R
from constella.operators.intervals import membership_intervals, merge_snapshots

d = dt.date


def members(spark, rows):
    return spark.createDataFrame(
        [("T", day, isin, True, "top_550") for isin, day in rows],
        "index_name string, review_date date, isin string, is_member boolean, entry_reason string")


def reviews(spark, days):
    return spark.createDataFrame([("T", x) for x in days], "index_name string, review_date date")


def spans(df):
    return sorted((r.isin, r.first_included, r.last_included) for r in df.collect())


def test_single_span_gap_reentries_single_date(spark):
    days = [d(2016, 2, 1), d(2016, 5, 1), d(2016, 8, 1), d(2016, 11, 1), d(2017, 2, 1), d(2017, 5, 1), d(2017, 8, 1)]
    rows = [("A", x) for x in days[:3]] + [("A", x) for x in days[5:]] + [("B", x) for x in days] + [("C", days[3])]
    got = spans(membership_intervals(members(spark, rows), reviews(spark, days)))
    assert got == [
        ("A", d(2016, 2, 1), d(2016, 8, 1)), ("A", d(2017, 5, 1), d(2017, 8, 1)),
        ("B", d(2016, 2, 1), d(2017, 8, 1)), ("C", d(2016, 11, 1), d(2016, 11, 1)),
    ]


def test_memberless_review_breaks_interval_and_duplicates_ignored(spark):
    days = [d(2024, 3, 1), d(2024, 6, 1), d(2024, 9, 1)]
    rows = [("A", days[0]), ("A", days[0]), ("A", days[2])]
    got = spans(membership_intervals(members(spark, rows), reviews(spark, days)))
    assert got == [("A", days[0], days[0]), ("A", days[2], days[2])]


def test_no_members_no_intervals(spark):
    assert membership_intervals(members(spark, []), reviews(spark, [d(2024, 3, 1)])).count() == 0


def _entries(spark, rows):
    return spark.createDataFrame(
        [("T", day, isin, ric, rank, k) for k, (day, isin, ric, rank) in enumerate(rows)],
        "index_name string, review_date date, isin string, ric string, rank int, ordinal bigint")


def test_fill_exit_and_reentry_daily(spark):
    r1, r2, r3 = d(2024, 3, 1), d(2024, 6, 1), d(2024, 9, 1)
    e = _entries(spark, [(r1, "A", "AAA.DE", 1), (r1, "B", "BBB.PA", 2), (r2, "A", "AAA.DE", 1),
                         (r2, "B", "BBB.PA", 2), (r3, "A", "AAA.DE", 2), (r3, "B", "BBB.PA", 1)])
    m = members(spark, [("A", r1), ("B", r1), ("A", r2), ("B", r3)])
    events = {(r.review_date, r.ric): r.rank for r in R.rank_events(e, m).collect()}
    assert events[(r2, "BBB.PA")] == 0 and events[(r3, "AAA.DE")] == 0 and events[(r3, "BBB.PA")] == 1
    daily = {(r.date, r.ric): r.rank for r in R.ranking_daily(e, m, "2024-09-30").collect()}
    assert daily[(d(2024, 5, 31), "BBB.PA")] == 2
    assert (d(2024, 6, 1), "BBB.PA") not in daily  # exit: null, not carried
    assert daily[(d(2024, 9, 1), "BBB.PA")] == 1  # re-entry
    assert daily[(d(2024, 8, 31), "AAA.DE")] == 1 and (d(2024, 9, 1), "AAA.DE") not in daily
    row = R.ranking_wide(e, m, "2024-09-30").where("date = date'2024-07-01'").collect()[0]
    assert row.ranks == {"AAA.DE": 1}


def test_first_member_row_wins_per_ric(spark):
    r1 = d(2024, 3, 1)
    e = _entries(spark, [(r1, "X", "DUP.L", 5), (r1, "Y", "DUP.L", 7)])
    m = members(spark, [("Y", r1)])
    assert [(r.ric, r.rank) for r in R.member_ranks(e, m).collect()] == [("DUP.L", 7)]


def test_rank_gaps_pass_fail_absent(spark):
    r1, r2, r3 = d(2024, 3, 1), d(2024, 6, 1), d(2024, 9, 1)
    rows = [("T", r1, f"R{i}", i) for i in range(1, 6)] + [("T", r2, f"R{i}", i) for i in (1, 2, 4)]
    daily = spark.createDataFrame(rows, "index_name string, date date, ric string, rank int")
    got = {r.review_date: (r.status, r.missing, r.missing_first10, r.distinct_ranks)
           for r in R.rank_gaps(daily, reviews(spark, [r1, r2, r3]), 5).collect()}
    assert got[r1] == ("passed", 0, "", 5)
    assert got[r2] == ("failed", 2, "3,5", 3)
    assert got[r3] == ("absent", 5, "1,2,3,4,5", 0) or got[r3][0] == "absent"


def test_merge_snapshots_existing_wins_and_widens(spark):
    old = spark.createDataFrame([("T", "A", "Old A", 1, None), ("T", "A", "Older", 2, None)],
                                "index_name string, isin string, name string, _row bigint, first_included date")
    new = spark.createDataFrame([("T", "A", "New A", "DE"), ("T", "B", "New B", "FR")],
                                "index_name string, isin string, name string, country string")
    got = sorted((r.isin, r.name, r.country) for r in merge_snapshots(old, new, ["index_name", "isin"]).collect())
    assert got == [("A", "Old A", None), ("B", "New B", "FR")]


def test_ranking_on_days_equals_filtered_daily(spark):
    r1, r2, r3 = d(2024, 3, 1), d(2024, 6, 1), d(2024, 9, 1)
    e = _entries(spark, [(r1, "A", "AAA.DE", 1), (r1, "B", "BBB.PA", 2), (r2, "A", "AAA.DE", 1),
                         (r3, "A", "AAA.DE", 2), (r3, "B", "BBB.PA", 1)])
    m = members(spark, [("A", r1), ("B", r1), ("B", r3)])  # r2 has no members: skipped, ranks carry
    days = spark.createDataFrame([("T", r1), ("T", r2), ("T", r3), ("T", d(2024, 9, 30))], "index_name string, date date")
    daily = R.ranking_daily(e, m, "2024-09-30").join(days, ["index_name", "date"], "left_semi")
    on = R.ranking_on(e, m, days, "2024-09-30")
    key = lambda df: sorted((r.date, r.ric, r.rank) for r in df.collect())
    assert key(on) == key(daily)
    assert (r2, "AAA.DE", 1) in key(on)


def test_late_ric_has_no_earlier_rows_and_null_rank_member_exits(spark):
    r1, r2 = d(2024, 3, 1), d(2024, 6, 1)
    e = _entries(spark, [(r1, "A", "AAA.DE", 1), (r2, "A", "AAA.DE", None), (r2, "C", "CCC.DE", 1)])
    m = members(spark, [("A", r1), ("A", r2), ("C", r2)])
    events = {(r.review_date, r.ric): r.rank for r in R.rank_events(e, m).collect()}
    assert (r1, "CCC.DE") not in events           # Q16: no row before first listing
    assert events[(r2, "AAA.DE")] == 0            # Q18: member without rank is an exit
    daily = {(r.date, r.ric) for r in R.ranking_daily(e, m, "2024-06-30").collect()}
    assert (d(2024, 6, 1), "AAA.DE") not in daily and (d(2024, 5, 31), "AAA.DE") in daily


def test_ranked_per_day_equals_counting_daily(spark):
    r1, r2 = d(2024, 3, 1), d(2024, 6, 1)
    e = _entries(spark, [(r1, "A", "AAA.DE", 1), (r1, "B", "BBB.PA", 2), (r2, "A", "AAA.DE", 1)])
    m = members(spark, [("A", r1), ("B", r1), ("A", r2)])
    daily = R.ranking_daily(e, m, "2024-07-15").groupBy("index_name", "date").count()
    want = sorted((r.date, r["count"]) for r in daily.collect())
    got = sorted((r.date, r.ranked) for r in R.ranked_per_day(e, m, "2024-07-15").collect())
    assert got == want and got[0] == (r1, 2) and got[-1] == (d(2024, 7, 15), 1)
