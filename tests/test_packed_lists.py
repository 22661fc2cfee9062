"""Packed (compressed) list files come back as the same lists as plain ones."""

import datetime as dt
import os

from pyspark.sql import functions as F

from constella.plans.book import ReviewBook, write_dialects
from constella.schemas import IndexRule
from constella.session import scratch_path
from constella.sources import selection as S
from constella.sources.dataset import ReviewDataset
from constella.streaming.incremental import start_list_stream

DAYS = (dt.date(1999, 1, 1), dt.date(2001, 4, 1))  # a report, a CSV list


def rows(spark, comment=None, n=40):
    return spark.createDataFrame(
        [(x, day, k, f"{k:07d}", "" if k % 9 == 0 else f"X{k:011d}", f"X{k:011d}", f"{k}.X", f"N{k}", "C", "EUR", "S",
          1.5 * k, k, comment) for x in ("AA", "BB") for day in DAYS for k in range(1, n + 1)],
        "index_name string, review_date date, ordinal long, internal_key string, raw_isin string, isin string, ric string, "
        "name string, country string, currency string, sedol string, ff_mcap double, rank int, comment string")


def files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.startswith("part-"))


def content(lists):
    return [sorted(map(str, df.drop("_path").collect())) for df in (lists.rows, lists.rejects, lists.dates)]


def test_packed_lists_are_the_same_lists(spark, tmp_path, monkeypatch):
    comment = 'one\n"two"; three'
    monkeypatch.setattr(S, "PART_ROWS", 15)
    plain, packed = f"{tmp_path}/plain", f"{tmp_path}/packed"
    write_dialects(rows(spark, comment), plain)
    write_dialects(rows(spark, comment), packed, packed=True)
    assert len(files(packed)) == len(files(plain)) == 8  # a report's part holds whole pages
    assert {os.path.splitext(f)[1] for f in files(packed)} == {".snappy"}
    want = content(S.read_lists(spark, plain))
    assert len(want[0]) == 4 * 40 - 8  # report rows without an ISIN are left out
    assert content(S.read_lists(spark, packed)) == want
    assert content(S.read_lists(spark, files(packed))) == want


def test_the_stream_takes_packed_lists(spark):
    src, ds = scratch_path(spark, "t-src"), ReviewDataset(spark, scratch_path(spark, "t-ds"))
    write_dialects(rows(spark), src, packed=True)
    start_list_stream(spark, src, ds, scratch_path(spark, "t-ckpt"), {
        x: IndexRule(auto=3, target=4, buffer_end=6, check_to=2) for x in ("AA", "BB")})
    assert {(r.index_name, r.review_date) for r in ds.pinned().table("reviews").collect()} == {
        (x, day) for x in ("AA", "BB") for day in DAYS}


def test_queries_write_packed_lists(spark):
    b = ReviewBook(spark, "no tables")
    b.__dict__["selection_rows"] = rows(spark)
    plain = scratch_path(spark, "t-plain")
    S.write_csv_lists(rows(spark, n=2000), plain)
    for path in (b.csv_dir, b.legacy_dir, b.lists_dir):
        assert files(path) and all(f.endswith(".snappy") for f in files(path))
    big = scratch_path(spark, "t-packed")
    S.write_csv_lists(rows(spark, n=2000), big, packed=True)
    size = {p: sum(os.path.getsize(f) for f in files(p)) for p in (plain, big)}
    assert size[big] < 0.6 * size[plain]
    assert S.read_csv_lists(spark, big).agg(F.count("*")).collect()[0][0] == 8000
