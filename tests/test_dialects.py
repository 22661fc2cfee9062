"""Both list dialects parsed from hand-written files (independent of the writers)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from constella.session import scratch_path
from constella.sources import selection as S

HEADER = "Internal_Key;ISIN;RIC;Instrument_Name;Country;Currency;Sedol;FF_Mcap_MEUR;Rank_Final;Comment;Creation_Date"


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def local(spark, name):
    path = scratch_path(spark, name)
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_lists(spark):
    root = local(spark, "t-csv")
    _write(f"{root}/index_name=IX/file=a.csv", "part-0.csv", [
        HEADER,
        "039600;DE0000000001;AAA.DE;Alpha AG ;DE;EUR; ;1234.5;1;;20240301",
        "039601;null;BBB.DE;Beta AG;DE;EUR;B123;;;new;20240302",
        "039602;;CCC.DE;Gamma AG;DE;EUR;;99.5;2; kept ;20240301",
    ])
    _write(f"{root}/index_name=IX/file=b.csv", "part-0.csv", [
        HEADER, "000007;FR0000000007;DDD.PA;Delta SA;FR;EUR;;10;1;;20240601",
    ])
    # Another layout: columns reordered, Sedol and Comment absent, quoted text.
    _write(f"{root}/index_name=IX/file=c.csv", "part-0.csv", [
        "Creation Date;Rank (Final);ISIN;Internal-Key;FF Mcap [MEUR];RIC;Instrument Name;Country;Currency",
        '20240901;3;IT0000000009;000009;55.5;EEE.MI;"Epsilon; SpA";IT;EUR',
    ])
    scan = S.read_csv_lists(spark, root)
    lookup = spark.createDataFrame([("IX", "039602", "DE0000000003")], "index_name string, internal_key string, isin string")
    rows = {r.internal_key: r for r in S.normalise_csv_lists(scan, lookup).collect()}
    a, b, c, d = rows["039600"], rows["039601"], rows["039602"], rows["000007"]
    assert a.review_date == b.review_date == dt.date(2024, 3, 1)  # first row's creation date
    assert d.review_date == dt.date(2024, 6, 1)
    assert (a.isin, b.isin, c.isin) == ("DE0000000001", "KEY_039601", "DE0000000003")
    assert a.name == "Alpha AG" and a.sedol is None and a.ff_mcap == 1234.5 and a.rank == 1
    assert b.ff_mcap is None and b.rank is None and b.comment == "new"
    assert c.comment == "kept"
    e = rows["000009"]
    assert (e.isin, e.rank, e.ff_mcap, e.name, e.sedol, e.comment) == ("IT0000000009", 3, 55.5, "Epsilon; SpA", None, None)
    assert e.review_date == dt.date(2024, 9, 1)
    dq = {r.file: (r.review_dates, r.ok) for r in S.csv_review_dates(scan).collect()}
    assert dq == {"a.csv": (2, False), "b.csv": (1, True), "c.csv": (1, True)}


REPORT_HEAD = ["ISIN", "Sedol", "RIC", "Int.Key", "Company Name", "Country", "Currency", "Component",
               "FF Mcap (BEUR)", "Rank\n(FINAL)", "Rank\n(PREVIOUS\n)"]
REPORT_ROWS = [
    {"page": 1, "row": 0, "cells": REPORT_HEAD},
    {"page": 1, "row": 1, "cells": ["GB0001", "", "AAA.L", "039600", "Alpha plc", "GB", "GBP", "Y", "1.23456", "1", ""]},
    {"page": 1, "row": 2, "cells": ["", "", "BBB.L", "039601", "Beta plc", "GB", "GBP", "Y", "2.0", "2", ""]},
    {"page": 1, "row": 3, "cells": ["Page 1"]},
    {"page": 2, "row": 1, "cells": ["GB0003", "S3", "CCC.L", "039602", "Gamma plc", "GB", "GBP", "N", "", "x", ""]},
    {"page": 2, "row": 2, "cells": ["GB0001", "", "ZZZ.L", "039609", "Alpha again", "GB", "GBP", "N", "3", "9", ""]},
]


def _report(root, name, lines, rows=REPORT_ROWS):
    _write(f"{root}/index_name=IX/file={name}.pdf", "part-0.json", [json.dumps(r) for r in [{"lines": lines}, *rows]])


def test_legacy_reports(spark):
    root = local(spark, "t-legacy")
    _report(root, "r1", ["Selection list", "Last Updated: 13.10.2015"])
    tables, lines = S.read_legacy_reports(spark, root)
    rows = S.normalise_legacy_reports(tables, lines)
    got = {(r.isin, r.ric): r for r in rows.collect()}
    assert set(got) == {("GB0001", "AAA.L"), ("GB0003", "CCC.L"), ("GB0001", "ZZZ.L")}
    alpha, gamma = got["GB0001", "AAA.L"], got["GB0003", "CCC.L"]
    assert abs(alpha.ff_mcap - 1234.56) < 1e-9 and alpha.internal_key == "039600"
    assert alpha.sedol is None and gamma.sedol == "S3"
    assert gamma["rank"] is None and gamma.ff_mcap is None
    assert alpha.review_date == dt.date(2015, 10, 13)
    assert {(r.isin, r.ric) for r in S.legacy_assets(rows).collect()} == {("GB0001", "AAA.L"), ("GB0003", "CCC.L")}
    rejects = {(r.file, r.ordinal, r.reason, r.value) for r in S.legacy_rejects(tables).collect()}
    assert rejects == {("r1.pdf", 1_000_002, "identifier", "039601"), ("r1.pdf", 1_000_003, "width", "1"),
                       ("r1.pdf", 2_000_001, "rank", "x")}


def test_records_over_several_lines(spark):
    root = local(spark, "t-torn")
    head = "Internal_Key;ISIN;Comment;Creation_Date;Rank_Final"
    _write(f"{root}/index_name=IX/file=torn.csv", "part-0.csv", [
        head, '01;DE01;"two', 'lines; and ""more""";20240301;1', "02;DE02;plain;20240301;2", "",
        '03;DE03;"x;y";20240301;3'])
    _write(f"{root}/index_name=IX/file=whole name.csv", "part-0.csv", [
        "Extra;" + head, 'e;04;DE04;5" pipe ""x"";20240601;1', 'e;05;DE05;"say ""hi""";20240601;2', "e;06;DE06"])
    rows = {r.internal_key: r for r in S.normalise_csv_lists(S.read_csv_lists(spark, root), None).collect()}
    assert rows["01"].comment == 'two\nlines; and "more"' and rows["01"]["rank"] == 1
    assert (rows["02"].comment, rows["03"].comment, rows["03"]["rank"]) == ("plain", "x;y", 3)
    assert rows["05"].comment == 'say "hi"' and rows["04"].isin == "DE04"
    assert rows["06"].isin == "DE06" and rows["06"].comment is None and rows["06"].review_date == dt.date(2024, 6, 1)
    assert len(rows) == 6


def test_wide_and_empty_lists(spark):
    root = local(spark, "t-wide")
    names = [f"col {i}" for i in range(60)]
    _write(f"{root}/index_name=IX/file=w.csv", "part-0.csv", [
        ";".join([*names, "ISIN", "Internal Key", "Creation Date"]), ";".join(["v"] * 60 + ["DE1", "1", "20240301"])])
    _write(f"{root}/index_name=IX/file=h.csv", "part-0.csv", [HEADER])
    (row,) = S.normalise_csv_lists(S.read_csv_lists(spark, root), None).collect()
    assert (row.isin, row.internal_key, row.review_date) == ("DE1", "1", dt.date(2024, 3, 1))
    empty = local(spark, "t-none")
    os.makedirs(empty)
    assert S.read_lists(spark, empty).rows.count() == 0 and S.read_lists(spark, []).dates.count() == 0


def test_mixed_folder_rejects_and_dates(spark):
    root = local(spark, "t-mixed")
    _report(root, "old", ["Last updated 20150301"])
    _report(root, "undated", ["no date at all"])
    _write(f"{root}/index_name=IX/file=new.csv", "part-0.csv", [
        HEADER, "01;DE01;A.DE;A;DE;EUR;;1;1;;20240301", ";null;B.DE;B;DE;EUR;;2;2;;20240301",
        "03;DE03;C.DE;C;DE;EUR;;1,5;1.5;;", "04;DE04;D.DE;D;DE;EUR;;;;;20240302"])
    lists = S.read_lists(spark, root)
    kinds = {(r.file, r.dialect) for r in lists.rows.collect()}
    assert kinds == {("old.pdf", "legacy"), ("undated.pdf", "legacy"), ("new.csv", "csv")}
    rejects = {(r.ordinal, r.reason, r.value) for r in lists.rejects.where("file = 'new.csv'").collect()}
    assert rejects == {(2, "identifier", "null"), (3, "rank", "1.5"), (3, "mcap", "1,5"), (3, "date", None)}
    dates = {r.file: (r.review_date, r.dates) for r in lists.dates.collect()}
    assert dates == {"old.pdf": (dt.date(2015, 3, 1), 1), "undated.pdf": (None, 0), "new.csv": (dt.date(2024, 3, 1), 2)}
    with pytest.raises(S.ListError, match="new.csv: 2 review dates; IX undated.pdf: no review date"):
        S.check_dates(lists.dates)
    S.check_dates(lists.dates.where("file = 'old.pdf'"))


def test_ranks(spark):
    ranks = spark.createDataFrame([("1",), ("1.0",), ("1.5",), (" ",), ("x",), ("1e30",)], "r string")
    assert [r[0] for r in ranks.select(S._rank(F.col("r"))).collect()] == [1, 1, None, None, None, None]


def test_legacy_repeated_and_blank_header_cells(spark):
    cells = ["ISIN", "", "", "Rank\n(FINAL)", "Int.Key", "Int.Key"]
    rows = [("f", "T", 1, 0, cells), ("f", "T", 1, 1, ["DE1", "p", "q", "3.0", "old", "new"])]
    df = spark.createDataFrame(rows, "file string, index_name string, page int, row int, cells array<string>")
    heads = spark.createDataFrame([("f", "T", ["Last updated 20200102"])],
                                  "file string, index_name string, lines array<string>")
    (r,) = S.normalise_legacy_reports(df, heads).collect()
    assert (r.isin, r.internal_key, r["rank"], str(r.review_date)) == ("DE1", "new", 3, "2020-01-02")


def test_lists_parsed_once_are_those_of_the_files(spark):
    root = local(spark, "t-once")
    _report(root, "old", ["Last updated 20150301"])
    _report(root, "undated", ["no date at all"])
    _report(root, "headless", ["Last updated 20160301"], REPORT_ROWS[1:])  # no row can be read, yet it is a list
    _report(root, "bare", ["Last updated 20170301"], REPORT_ROWS[:1])
    _write(f"{root}/index_name=IX/file=new.csv", "part-0.csv", [
        HEADER, "01;DE01;A.DE;A;DE;EUR;;1;1;;20240301", ";null;B.DE;B;DE;EUR;;2;2;;20240301",
        "03;;C.DE;C;DE;EUR;;1,5;1.5;;", "04;DE04;D.DE;D;DE;EUR;;;;;20240302"])
    _write(f"{root}/index_name=IX/file=undated.csv", "part-0.csv", [HEADER, "01;DE01;A.DE;A;DE;EUR;;1;1;;"])
    lookup = spark.createDataFrame([("IX", "03", "DE03")], "index_name string, internal_key string, isin string")
    lists = S.read_lists(spark, root, lookup)
    once = lists.once()
    for part in ("rows", "rejects", "dates"):
        want, got = getattr(lists, part), getattr(once, part)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert once.dates.count() == 6 and once.rows.where("isin = 'DE03'").count() == 1
    for part in (once.rows, once.rejects, once.dates):  # nothing reads the files again
        assert {f.rsplit(".", 1)[1] for f in part.inputFiles()} == {"parquet"}
    assert once.rows.count() == 11
