"""Identifier resolution, header names and dates, calendar, dataset round trip."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from constella.functions import calendar as C
from constella.functions.names import normalize_name_col
from constella.operators import resolve as X
from constella.session import scratch_path
from constella.sources import selection as S
from constella.sources.dataset import ReviewDataset, require_index


def test_resolve_isin_cases(spark):
    rows = [("T", "1", "DE0001"), ("T", "2", ""), ("T", "3", "null"), ("T", "4", " None "), ("T", "5", None),
            ("T", " 6 ", "NULL"), ("T", "7", "  FR0007 ")]
    df = spark.createDataFrame(rows, "index_name string, internal_key string, raw_isin string")
    lookup = spark.createDataFrame([("T", "2", "GB0002"), ("T", "6", "GB0006")],
                                   "index_name string, internal_key string, isin string")
    got = {r.internal_key: r.isin for r in X.resolve_isins(df, lookup).collect()}
    assert got == {"1": "DE0001", "2": "GB0002", "3": "KEY_3", "4": "KEY_4", "5": "KEY_5", "6": "GB0006",
                   "7": "FR0007"}
    no_lookup = {r.internal_key: r.isin for r in X.resolve_isins(df, None).collect()}
    assert no_lookup["2"] == "KEY_2"


def test_lookup_exclusions_and_last_wins(spark):
    rows = [("T", "1", "OLD1", 1), ("T", "1", "NEW1", 2), ("T", "2", "KEY_2", 3), ("T", "3", "  ", 4),
            ("T", "", "X", 5), ("T", "4", "GOOD4", 6), ("T", "4", "KEY_4", 7), ("T", " 5 ", " P5 ", 8)]
    hist = spark.createDataFrame(rows, "index_name string, internal_key string, isin string, ordinal bigint")
    got = {r.internal_key: r.isin for r in X.isin_lookup(hist).collect()}
    assert got == {"1": "NEW1", "4": "GOOD4", "5": "P5"}


def test_enrichment_falls_back_to_ric_and_keeps_rows(spark):
    assets = spark.createDataFrame(
        [("T", "I1", "R1"), ("T", "I2", "R2b"), ("T", "I2", "R2a"), ("T", "I3", "R3"), ("T", "I3", "R3"),
         ("T", "I4", None)], "index_name string, isin string, ric string")
    responses = spark.createDataFrame(
        [("T", "isin", '{"I1": {"alpha_id": "E1"}, "I3": null, "I4": {"alpha_id": null}}'),
         ("T", "ric", '{"R2a": {"alpha_id": "E2a"}, "R2b": {"alpha_id": "E2b"}, "R3": {"alpha_id": "E3"}}')],
        "index_name string, endpoint string, response string")
    ents = X.unnest_entities(responses)
    assert ents.count() == 4
    out = X.enrich_ids(assets, ents)
    assert out.count() == assets.count()
    got = sorted(set((r.isin, r.entity_id) for r in out.collect()))
    assert got == [("I1", "E1"), ("I2", "E2a"), ("I3", "E3"), ("I4", None)]
    report = X.unresolved_report(out).collect()
    assert [r.isin for r in report] == ["I4"]


def test_enrichment_counts_and_refuses_other_row_counts(spark, monkeypatch):
    assets = spark.createDataFrame(
        [("T", "I1", "R1"), ("T", "I2", "R2"), ("T", "I2", "R2"), ("T", "I3", None)],
        "index_name string, isin string, ric string")
    ents = spark.createDataFrame(
        [("T", "isin", "I1", "E1"), ("T", "ric", "R2", "E2"), ("T", "ric", "R9", "E9")],
        "index_name string, endpoint string, id string, alpha_id string")
    out, counts = X.enrich_counted(assets, ents)
    assert counts == {"rows_before": 4, "rows_after": 4, "by_isin": 1, "by_ric": 2, "unresolved": 1}
    assert out.count() == 4
    real = X.enrich_ids
    monkeypatch.setattr(X, "enrich_ids", lambda a, e, c, seen: real(a, e, c, (seen[0], X.Observation("spare"))).join(
        ents.select("index_name").limit(2), "index_name").observe(
        seen[1], F.count(F.lit(1)).alias("rows"), *[F.count(F.lit(1)).alias(k) for k in ("by_isin", "by_ric", "unresolved")]))
    with pytest.raises(X.RowsChanged, match="4 rows went in, 8 came out"):
        X.enrich_counted(assets, ents)


@pytest.mark.parametrize("raw,want", [
    ("FF Mcap (BEUR)", "ff_mcap_beur"), ("Int.Key", "int_key"), ("Rank\n(FINAL)", "rank_final"),
    ("Rank\n(PREVIOUS\n)", "rank_previous"), (" Company  Name ", "company_name"), ("a--b..c", "a_b_c"),
    ("[x]", "x"),
])
def test_normalize_name(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "c string").select(normalize_name_col(F.col("c"))).first()[0]
    assert got == want


def test_header_dates(spark):
    rows = [("f1", "T", ["Title", "Last Updated: 13.10.2015", "x"]),
            ("f2", "T", ["Last updated 20230901"]),
            ("f3", "T", ["last updated by the team", "nothing", "LAST UPDATED 1.2.2016"]),
            ("f4", "T", ["no date here", "Last updated: soon"])]
    lines = spark.createDataFrame(rows, "file string, index_name string, lines array<string>")
    got = {r.file: r.review_date for r in S.header_review_dates(lines).collect()}
    assert got == {"f1": dt.date(2015, 10, 13), "f2": dt.date(2023, 9, 1), "f3": dt.date(2016, 2, 1)}


def test_vendor_calendar_periods(spark):
    spans = spark.createDataFrame([("V", dt.date(2015, 10, 1), dt.date(2024, 12, 31))],
                                  "index_name string, start date, end date")
    periods = [(r.year, r.month) for r in C.review_periods(spans, C.VENDOR_CALENDAR).orderBy("year", "month").collect()]
    assert len(periods) == 37
    assert periods[:2] == [(2015, 10), (2015, 11)]
    assert [m for y, m in periods if y == 2018] == [2, 5, 11]
    assert [m for y, m in periods if y == 2021] == [3, 6, 9, 12]
    short = spark.createDataFrame([("V", dt.date(2024, 5, 15), dt.date(2024, 9, 1))],
                                  "index_name string, start date, end date")
    assert [r.month for r in C.review_periods(short, C.VENDOR_CALENDAR).collect()] == [6, 9]


def test_publication_search_window(spark):
    cal = C.VENDOR_CALENDAR
    periods = spark.createDataFrame(
        [("V", 2024, 3, dt.date(2024, 3, 1)), ("V", 2024, 12, dt.date(2024, 12, 1)), ("V", 2024, 9, dt.date(2024, 9, 1)),
         ("V", 2016, 2, dt.date(2016, 2, 1))],
        "index_name string, year int, month int, period_date date")
    pubs = spark.createDataFrame(
        [("V", dt.date(2024, 4, 20)), ("V", dt.date(2024, 6, 2)), ("V", dt.date(2025, 1, 5)),
         ("V", dt.date(2024, 11, 30)), ("V", dt.date(2016, 2, 9))],
        "index_name string, pub_date date")
    got = {r.month: (r.pub_date, r.file_key, r.status) for r in C.match_publications(periods, pubs, cal).collect()}
    assert got[3] == (dt.date(2024, 4, 20), "slpublic_v_20240420.csv", "downloaded")
    assert got[12][2] == "missed"  # December searches December only
    assert got[9][:2] == (dt.date(2024, 11, 30), "slpublic_v_20241130.csv")  # Sep..Nov searched
    assert got[2] == (dt.date(2016, 2, 9), "sl_v_201602.pdf", "downloaded")


def test_a_late_list_closes_its_period(spark):
    cal = C.VENDOR_CALENDAR
    periods = spark.createDataFrame(
        [("V", 2024, 3, dt.date(2024, 3, 1)), ("V", 2024, 6, dt.date(2024, 6, 1)), ("V", 2016, 2, dt.date(2016, 2, 1))],
        "index_name string, year int, month int, period_date date")
    reviews = spark.createDataFrame(
        [("V", dt.date(2024, 4, 20)), ("V", dt.date(2016, 3, 1)), ("W", dt.date(2024, 6, 3))],
        "index_name string, review_date date")
    got = {(r.index_name, r.review_date): r.period_date for r in C.periods_of_reviews(periods, reviews, cal).collect()}
    assert got == {("V", dt.date(2024, 4, 20)): dt.date(2024, 3, 1), ("V", dt.date(2016, 3, 1)): None,
                   ("W", dt.date(2024, 6, 3)): None}
    # the April list closes March; reports are looked for in their own month only
    assert sorted(r.month for r in C.open_periods(periods, reviews, cal).collect()) == [2, 6]


def test_dataset_roundtrip_dynamic_overwrite(spark):
    ds = ReviewDataset(spark, scratch_path(spark, "test-ds"))
    day1, day2 = dt.date(2024, 3, 1), dt.date(2024, 6, 1)
    assets = spark.createDataFrame([("T", "A", "RA")], "index_name string, isin string, ric string")
    e = spark.createDataFrame([("T", day1, "A", 1, 1), ("T", day2, "A", 2, 1)],
                              "index_name string, review_date date, isin string, rank int, ordinal bigint")
    m = spark.createDataFrame([("T", day1, "A", True, "bootstrap"), ("T", day2, "A", True, "top_550")],
                              "index_name string, review_date date, isin string, is_member boolean, entry_reason string")
    ds.write(assets, e, m)
    assert ds.latest("T") == day2
    m2 = spark.createDataFrame([("T", day2, "A", True, "fill_to_600")], m.schema)
    ds.write(assets, e.where(F.col("review_date") == day2), m2)
    got = sorted((r.review_date, r.entry_reason) for r in ds.table("membership").collect())
    assert got == [(day1, "bootstrap"), (day2, "fill_to_600")]
    assert ds.constituents().first().ric == "RA"
    assert [r.ric for r in ds.table("entries").collect()] == ["RA", "RA"]
    with pytest.raises(KeyError, match="only: T"):
        require_index(ds, "NOPE")
    with pytest.raises(ValueError):
        ds.latest("NOPE")
