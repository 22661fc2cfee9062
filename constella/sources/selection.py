"""Selection-list files: the CSV dialect and the older extracted-report dialect.

One folder may hold files of both, told apart by their suffix.  Both are read in
one job for any number of files.  Order-dependent rules ("first row", "first
line") use an explicit ordinal: (file path, block start, monotonically increasing
id) — rows of one split keep their file order and splits of one file are ordered
by their start offset.

Rows that cannot be used as they are come out beside the lists (``csv_rejects``,
``legacy_rejects``), and ``check_dates`` refuses lists without exactly one review
date, as the first step of a write.

Writers here produce such files from derived lists (for round trips, tests
and the incremental-ingestion demo); readers are what a user points at the
vendor's files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from constella.functions.names import normalize_name_col
from constella.operators.intervals import first_per_key
from constella.operators.resolve import resolve_isins, valid_isin
from constella.schemas import LEGACY_COLUMNS, SELECTION_CSV_COLUMNS
from constella.session import staged


def _blank_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _rank(c: Column) -> Column:
    """A rank, also written as a whole decimal ('1.0'); other text is no rank."""
    number = _blank_null(c).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def _day(c: Column) -> Column:
    """A ``yyyyMMdd`` date; eight digits are cast, which costs a fraction of a parse by pattern."""
    text = F.trim(c)
    plain = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike("^(?!0000)[0-9]{8}$"), plain.try_cast("date")).otherwise(F.try_to_date(text, "yyyyMMdd"))


def _file_key(path_col: Column, part: str) -> Column:
    return F.regexp_extract(path_col, rf"{part}=([^/]+)", 1)


# --------------------------------------------------------------------- writing


def csv_file_key(index_col: Column, day: Column) -> Column:
    return F.concat(F.lit("slpublic_"), F.lower(index_col), F.lit("_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv"))


def legacy_file_key(index_col: Column, day: Column) -> Column:
    return F.concat(F.lit("sl_"), F.lower(index_col), F.lit("_"), F.date_format(day, "yyyyMM"), F.lit(".pdf"))


# Rows of one written file; a longer list comes in several parts, so that no task writes a whole one.
PART_ROWS = 250_000
# Codec of lists that a query writes for itself.  Its files cannot be split, but a part is read by one task anyway.
PACKED = "snappy"


def _codec(packed: bool) -> dict[str, str]:
    return {"compression": PACKED} if packed else {}


def write_csv_lists(
    rows: DataFrame, path: str, raw_isins: bool = True, within: tuple[str, ...] = (), packed: bool = False
) -> None:
    """';'-separated files with header per (index, review), rows in list order: one for each ``PART_ROWS`` places.

    The texts that follow from a row's numbers and date are made behind the shuffle.  With ``within``, lists of
    one name lie apart by these columns (folders above ``index_name``).  ``packed`` files are compressed.
    """
    part = F.floor((F.col("ordinal") - 1) / PART_ROWS)
    dealt = rows.select(*within, "index_name", "review_date", "ordinal", "internal_key", "raw_isin" if raw_isins else "isin",
                        "ric", "name", "country", "currency", "sedol", "ff_mcap", "rank", "comment").repartition(
        *within, "index_name", "review_date", part)
    out = dealt.select(
        *within,
        "index_name",
        csv_file_key(F.col("index_name"), F.col("review_date")).alias("file"),
        part.alias("part"),
        "ordinal",
        F.col("internal_key").alias("Internal_Key"),
        F.col("raw_isin" if raw_isins else "isin").alias("ISIN"),
        F.col("ric").alias("RIC"),
        F.col("name").alias("Instrument_Name"),
        F.col("country").alias("Country"),
        F.col("currency").alias("Currency"),
        F.col("sedol").alias("Sedol"),
        F.col("ff_mcap").cast("string").alias("FF_Mcap_MEUR"),
        F.col("rank").cast("string").alias("Rank_Final"),
        F.col("comment").alias("Comment"),
        F.date_format("review_date", "yyyyMMdd").alias("Creation_Date"),
    )
    assert tuple(out.columns[len(within) + 4:]) == SELECTION_CSV_COLUMNS
    (
        out.sortWithinPartitions(*within, "index_name", "file", "part", "ordinal")
        .drop("ordinal")
        .write.mode("append")
        .partitionBy(*within, "index_name", "file", "part")
        .options(sep=";", header=True, quote='"', escape='"', **_codec(packed))
        .csv(path)
    )


def beur_text(ff_mcap: Column) -> Column:
    """Market cap in billions as report text, exact from integer cents."""
    cents = F.round(ff_mcap * 100).cast("bigint")
    whole = ((cents - F.pmod(cents, F.lit(100000))) / F.lit(100000)).cast("bigint")
    return F.concat(
        whole.cast("string"),
        F.lit("."),
        F.lpad(F.pmod(cents, F.lit(100000)).cast("string"), 5, "0"),
    )


def header_lines(index_col: Column, day: Column) -> Column:
    """Report header text: the 'last updated' line in one of two date styles."""
    month = F.month(day)
    dotted = F.concat(F.lit("Last Updated: "), F.date_format(day, "d.M.yyyy"))
    compact = F.concat(F.lit("Last updated "), F.date_format(day, "yyyyMMdd"))
    return F.when(month == 4, F.array(F.concat(index_col, F.lit(" selection list")),
                                      F.lit("Last updated by the index team"), compact, F.lit("Page 1"))).otherwise(
        F.array(F.concat(index_col, F.lit(" selection list")),
                F.when(month.isin(1, 7), dotted).otherwise(compact), F.lit("Page 1"))
    )


def write_legacy_reports(rows: DataFrame, path: str, page_size: int = 40, packed: bool = False) -> None:
    """Reports per (index, review) as JSON lines: header lines, then table rows (a header row on page 1, a footer
    per page); one file for each ``PART_ROWS`` places.  ``packed`` files are compressed.

    A page's first row brings its footer, and that of page 1 the header row and lines, so the rows are read once.
    """
    pos = F.col("ordinal") - 1
    pages = max(1, PART_ROWS // page_size)
    # a report holds a month; the texts that follow from a row's numbers and date are made behind the shuffle
    dealt = rows.select(
        "index_name", F.trunc("review_date", "month").alias("_month"), F.floor(pos / (pages * page_size)).alias("part"),
        "review_date", "ordinal", "raw_isin", "sedol", "ric", "internal_key", "name", "country", "currency", "ff_mcap", "rank",
    ).repartition("index_name", "_month", "part")
    data = dealt.select(
        "index_name",
        "_month",
        "part",
        "review_date",
        (F.floor(pos / page_size) + 1).cast("int").alias("page"),
        (F.pmod(pos, F.lit(page_size)) + 1).cast("int").alias("row"),
        F.array(
            F.coalesce("raw_isin", F.lit("")),
            F.coalesce("sedol", F.lit("")),
            F.coalesce("ric", F.lit("")),
            F.col("internal_key"),
            F.coalesce("name", F.lit("")),
            F.coalesce("country", F.lit("")),
            F.coalesce("currency", F.lit("")),
            F.lit("Y"),
            beur_text(F.col("ff_mcap")),
            F.coalesce(F.col("rank").cast("string"), F.lit("")),
            F.lit(""),
        ).alias("cells"),
    )
    page = F.struct("review_date", "page")
    in_order = Window.partitionBy("index_name", "_month", "part").orderBy("review_date", "page", "row")
    opens = ~F.lag(page).over(in_order).eqNullSafe(page)

    def line(page: Column | None, row: Column | None, cells: Column | None, lines: Column | None = None) -> Column:
        fields = {"page": (page, "int"), "row": (row, "int"), "cells": (cells, "array<string>"),
                  "lines": (lines, "array<string>")}
        return F.struct(*[(F.lit(None) if c is None else c).cast(t).alias(n) for n, (c, t) in fields.items()])

    own = line(F.col("page"), F.col("row"), F.col("cells"))
    footer = line(F.col("page"), F.lit(999), F.array(F.concat(F.lit("Page "), F.col("page").cast("string"))))
    header = line(F.col("page"), F.lit(0), F.array(*[F.lit(c) for c in LEGACY_COLUMNS]))
    heads = line(None, None, None, header_lines(F.col("index_name"), F.col("review_date")))
    file = legacy_file_key(F.col("index_name"), F.col("review_date"))
    out = data.withColumn("_opens", opens).select("index_name", file.alias("file"), "part", F.inline(
        F.when(~F.col("_opens"), F.array(own)).when(F.col("page") > 1, F.array(own, footer)).otherwise(
            F.array(own, footer, header, heads))))
    out.write.mode("append").partitionBy("index_name", "file", "part").options(**_codec(packed)).json(path)


# --------------------------------------------------------------------- reading


# Normalised names of the CSV dialect's columns (selected by name, so the
# order of columns in a file does not matter and absent ones are null).
LIST_FIELDS = (
    "internal_key", "isin", "ric", "instrument_name", "country", "currency", "sedol", "ff_mcap_meur",
    "rank_final", "comment", "creation_date",
)
CSV_SUFFIX, REPORT_SUFFIX = ".csv", ".json"
# behind a list's suffix: nothing, or that of the codec
PACKED_GLOB = f"{{,.{PACKED}}}"


def _files(spark: SparkSession, where: str | list[str], suffix: str):
    """(reader, paths) of the files with a suffix, packed or not: those of a folder, or of a list of paths; None
    without any."""
    if isinstance(where, str):
        return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}{PACKED_GLOB}"), where
    paths = [p for p in where if p.lower().endswith((suffix, f"{suffix}.{PACKED}"))]
    return (spark.read, paths) if paths else None


def _placed(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(
        *columns,
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    )


def _list_path(path: Column) -> Column:
    """The path that all parts of a written list share; other files are a list each."""
    return F.regexp_replace(path, r"/part=\d+/part-\d+-([^/]*)$", "/$1")


def _as_metadata(file: str) -> str:
    """A file of a frame's listing as ``_metadata.file_path`` writes it: no slashes for an absent host."""
    return re.sub(r"^([^:/]+):///", r"\1:/", file)


def _part(path: Column) -> Column:
    """Place of a file among the parts of its list."""
    return F.coalesce(F.regexp_extract(path, r"/part=(\d+)/part-\d+-[^/]*$", 1).try_cast("long"), F.lit(0).cast("long"))


CELLS = {"sep": ";", "quote": '"', "escape": '"'}
# of a line that Spark's CSV reader skips
_SPACE = "".join(map(chr, range(33)))
# bits for a block's first byte below the number of its file's part
PART_BIT = 40


def _csv_cells(spark: SparkSession, where: str | list[str]) -> tuple[DataFrame, DataFrame] | None:
    """Rows of all CSV files as arrays of texts (_cells, _path, _block, _mid), header rows included, and every
    file's first row (_path, _cells).

    A pass over the lines first finds, per file, its first line and whether a line has an odd number of
    quotes, so that a quoted cell may run over a line break.  Such files are read in one piece each
    (``multiLine``); all others can be split, however large.
    """
    found = _files(spark, where, CSV_SUFFIX)
    if found is None:
        return None
    reader, paths = found
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # most lines are told by their first character not to be blank, and have no quote
    lines = _placed(reader.text(paths), "value").where(
        (F.col("value") >= "!") | (F.btrim("value", F.lit(_SPACE)) != ""))
    odd = F.when(F.col("value").contains('"'), quotes % 2).otherwise(0)
    # one short row per split, of numbers only: with min_by on the lines Spark would sort or box all of them
    splits = lines.groupBy("_path", "_block").agg(F.min("_mid").alias("first"), F.max(odd).alias("odd")).collect()
    if not splits:
        return None
    firsts: dict[str, tuple[int, int]] = {}
    for s in splits:
        firsts[s["_path"]] = min(firsts.get(s["_path"], (s["_block"], s["first"])), (s["_block"], s["first"]))
    places = spark.createDataFrame([(p, *at) for p, at in firsts.items()], "_path string, _block long, _mid long")
    torn_paths = {s["_path"] for s in splits if s["odd"]}
    heads_of = lines.join(F.broadcast(places), ["_mid", "_path", "_block"], "left_semi").select("_path", "value").collect()
    assert len(heads_of) == len(firsts), "the list files changed while they were read"
    files = [{"_path": p, "head": line, "cells": line.count(";") + 1, "torn": p in torn_paths} for p, line in heads_of]
    cells = [f"c{k}" for k in range(max(f["cells"] for f in files))]
    schema = ", ".join(f"{c} string" for c in cells)
    scans, heads = [], []
    for torn in (False, True):
        part = [f for f in files if f["torn"] == torn]
        if not part:
            continue
        scan = spark.read.schema(schema).options(header=False, multiLine=torn, **CELLS).csv(
            [unquote(f["_path"]) for f in part])
        placed = _placed(scan, F.array(*cells).alias("_cells"))
        scans.append(placed)
        if torn:  # a header cell may run over lines as well
            heads.append(placed.groupBy("_path").agg(
                F.min_by("_cells", F.struct("_block", "_mid")).alias("_cells"), F.collect_set(F.lit(1)).alias("_")).drop("_"))
        else:
            lines = spark.createDataFrame([(f["_path"], f["head"]) for f in part], "_path string, line string")
            heads.append(lines.select("_path", F.from_csv("line", schema, CELLS).alias("r")).select(
                "_path", F.array(*[F.col(f"r.{c}") for c in cells]).alias("_cells")))
    return tuple(x[0] if len(x) == 1 else x[0].unionByName(x[1]) for x in (scans, heads))


_SCAN = ", ".join(f"{c} string" for c in LIST_FIELDS) + ", _path string, _block long, _mid long, _place long"


def bind_by_header(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Bind every file's rows to that file's own header row.

    ``rows`` has (_cells, _path, _block, _mid), ``heads`` every file's first row (_path, _cells); cells are
    selected by the place of the normalised header name.  ``_path`` becomes the list's, ``_block`` is
    ordered over its parts, and ``_place`` is a row's place in its list.  One short row for each split (where its
    rows begin, how many lie before it) is broadcast: nothing else is moved to find a row's header or place.
    """
    # whole numbers only: a pass that parses no cell and sorts no row
    splits = rows.groupBy("_path", "_block").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_file, of_list = Window.partitionBy("_path").orderBy("_block"), Window.partitionBy("_list").orderBy("_order")
    skip = F.when(F.row_number().over(of_file) == 1, 1).otherwise(0)  # the header row
    names = heads.select("_path", F.transform(
        "_cells", lambda c: F.coalesce(normalize_name_col(c), F.lit(""))).alias("_header"))
    at = {name: F.array_position("_header", name).cast("int") for name in LIST_FIELDS}
    names = names.select("_path", *[F.when(k > 0, k - 1).alias(f"_at_{name}") for name, k in at.items()])
    starts = splits.withColumn("_skip", skip).join(F.broadcast(names), "_path").select(
        "_path", "_block", (F.col("_first") + F.col("_skip")).alias("_first"), (F.col("_n") - F.col("_skip")).alias("_n"),
        *[f"_at_{name}" for name in LIST_FIELDS], _list_path(F.col("_path")).alias("_list"),
        (F.shiftleft(_part(F.col("_path")), PART_BIT) + F.col("_block")).alias("_order"))
    starts = staged(starts.withColumn("_before", F.coalesce(
        F.sum("_n").over(of_list.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "list-splits")
    data = rows.join(F.broadcast(starts), ["_path", "_block"], "inner").where(F.col("_mid") >= F.col("_first"))
    # a header row has no values, in whatever order Spark puts this filter and those on the values
    listed = F.col("_mid") >= F.col("_first")
    return data.select(
        *[F.when(listed, F.get("_cells", F.col(f"_at_{name}"))).alias(name) for name in LIST_FIELDS],
        F.col("_list").alias("_path"), F.col("_order").alias("_block"), "_mid",
        (F.col("_before") + F.col("_mid") - F.col("_first") + 1).alias("_place"),
    )


def read_csv_lists(spark: SparkSession, where: str | list[str], once: bool = False) -> DataFrame:
    """S1 scan: all CSV lists of a folder (or of some paths), each bound to its own header.

    With ``once`` the files are parsed now and the scan is a staged copy, for who reads it more than once:
    ``normalise_csv_lists`` does for the dates, the rows with an ISIN and those to look up.
    """
    found = _csv_cells(spark, where)
    if found is None:
        return spark.createDataFrame([], _SCAN)
    scan = bind_by_header(*found)
    # texts that seldom repeat: Parquet's dictionaries would be built and thrown away
    return staged(scan, "list-cells", {"parquet.enable.dictionary": "false"}) if once else scan


def normalise_csv_lists(scan: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """One clean row per list row (asset and entry fields).

    The review date of a file is the creation date of its first row.  Only rows without a valid ISIN are moved
    to meet ``lookup`` (one row per key).
    """
    files = scan.groupBy("_path").agg(
        F.min_by(_day(F.col("creation_date")), "_place").alias("review_date")
    )
    # one short row for each list
    files = files.select("_path", _file_key(F.col("_path"), "index_name").alias("index_name"),
                         _file_key(F.col("_path"), "file").alias("file"), "review_date")
    rows = scan.join(F.broadcast(files), "_path", "inner").select(
        "index_name",
        "file",
        "review_date",
        F.col("internal_key"),
        F.col("isin").alias("raw_isin"),
        F.trim("ric").alias("ric"),
        F.trim("instrument_name").alias("name"),
        F.trim("country").alias("country"),
        F.trim("currency").alias("currency"),
        _blank_null(F.col("sedol")).alias("sedol"),
        _blank_null(F.col("ff_mcap_meur")).try_cast("double").alias("ff_mcap"),
        _rank(F.col("rank_final")).alias("rank"),
        _blank_null(F.col("comment")).alias("comment"),
        "_path",
        "_block",
        "_mid",
        "_place",
        *[c for c in ("faults", "day") if c in scan.columns],
    )
    if lookup is None:
        return resolve_isins(rows, None)
    valid = valid_isin(F.col("raw_isin"))
    return resolve_isins(rows.where(valid), None).unionByName(resolve_isins(rows.where(~valid), lookup))


REJECT_COLUMNS = ("index_name", "file", "ordinal", "reason", "value")


Reasons = dict[str, tuple[Column, Column]]


def _faults(reasons: Reasons) -> Column:
    return F.array_compact(F.array(*[
        F.when(bad, F.struct(F.lit(reason).alias("reason"), value.alias("value")))
        for reason, (bad, value) in reasons.items()]))


def _faulty(reasons: Reasons) -> Column:
    # most rows have no fault: they are left out before an array is made
    return reduce(or_, [bad for bad, _ in reasons.values()])


def _rejected(rows: DataFrame, reasons: Reasons) -> DataFrame:
    """One row per fault of a row: (index_name, file, ordinal, reason, value)."""
    return rows.where(_faulty(reasons)).select("index_name", "file", "ordinal", F.inline(_faults(reasons)))


def _unread(text: Column, value: Column, number: str) -> Column:
    """Text that is not blank but has no value."""
    # a number is told first, by one cast (of a number's text no value is null): most texts are numbers
    return text.try_cast(number).isNull() & _blank_null(text).isNotNull() & value.isNull()


def csv_rejects(scan: DataFrame) -> DataFrame:
    """What a CSV row says that cannot be used: an unreadable ``rank`` (the row goes unranked) or
    market cap (``mcap``), a blank or unreadable creation ``date`` (the file's first one counts), neither ISIN
    nor key (``identifier``: the row is left out)."""
    rows = scan.select(
        _file_key(F.col("_path"), "index_name").alias("index_name"), _file_key(F.col("_path"), "file").alias("file"),
        F.col("_place").alias("ordinal"), "rank_final", "ff_mcap_meur", "creation_date", "isin", "internal_key")
    return _rejected(rows, _csv_reasons())


def _csv_reasons() -> Reasons:
    date = _day(F.col("creation_date"))
    return {
        "rank": (_unread(F.col("rank_final"), _rank(F.col("rank_final")), "int"), F.col("rank_final")),
        "mcap": (_unread(F.col("ff_mcap_meur"), _blank_null(F.col("ff_mcap_meur")).try_cast("double"), "double"),
                 F.col("ff_mcap_meur")),
        "date": (date.isNull(), F.col("creation_date")),
        "identifier": (~valid_isin(F.col("isin")) & _blank_null(F.col("internal_key")).isNull(), F.col("isin")),
    }


def csv_dates(scan: DataFrame) -> DataFrame:
    """Per CSV file its review date (the first row's) and how many dates its rows name."""
    day = _day(F.col("creation_date"))
    return scan.groupBy("_path").agg(
        F.min_by(day, "_place").alias("review_date"), F.countDistinct(day).alias("dates")).select(
        _file_key(F.col("_path"), "index_name").alias("index_name"), _file_key(F.col("_path"), "file").alias("file"),
        "review_date", "dates")


class ListError(ValueError):
    """Lists that must not be written."""


def check_dates(dates: DataFrame, shown: int = 10) -> None:
    """Every list needs exactly one review date; raises ``ListError`` before anything is written."""
    bad = dates.where(F.col("review_date").isNull() | (F.col("dates") != 1)).orderBy("index_name", "file")
    rows = bad.limit(shown).collect()
    if rows:
        raise ListError("; ".join(
            f"{r.index_name} {r.file}: " + ("no review date" if r.review_date is None else f"{r.dates} review dates")
            for r in rows))


def csv_review_dates(scan: DataFrame) -> DataFrame:
    """V2: distinct creation dates per file (a write needs exactly one)."""
    return scan.groupBy(
        _file_key(F.col("_path"), "index_name").alias("index_name"), _file_key(F.col("_path"), "file").alias("file")
    ).agg(F.countDistinct(F.trim("creation_date")).alias("review_dates")).withColumn(
        "ok", F.col("review_dates") == 1
    )


def csv_assets(rows: DataFrame, by_internal_key: bool) -> DataFrame:
    """Assets of each file: first row per internal key (with a lookup) or per raw ISIN (Q12)."""
    key = "internal_key" if by_internal_key else "raw_isin"
    cols = ["isin", "ric", "name", "country", "currency", "sedol"]
    cols = [c for c in cols if c != key]
    return first_per_key(rows, ["index_name", "file", key], ["_block", "_mid"], cols)


def read_legacy_reports(spark: SparkSession, where: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """S2 scan: table rows and header lines of all extracted reports of a folder (or of some paths)."""
    found = _files(spark, where, REPORT_SUFFIX)
    columns = "page int, row int, cells array<string>, lines array<string>"
    keys = ("file", "index_name")
    if found is None:
        raw = spark.createDataFrame([], f"{columns}, _path string, file string, index_name string")
        return raw.select(*keys, "page", "row", "cells", "_path"), raw.select(*keys, "lines")
    reports = found[0].schema(columns).json(found[1])
    at = F.col("_metadata.file_path").alias("_at")
    # a row's list and keys follow from its file: they are cut from the path once a file, not once a row
    path = _list_path(F.col("_at"))
    names = F.broadcast(spark.createDataFrame([(_as_metadata(p),) for p in reports.inputFiles()], "_at string").select(
        "_at", path.alias("_known"), *[_file_key(path, k).alias(f"_known_{k}") for k in keys]))

    def named(df: DataFrame, *columns: str) -> DataFrame:
        # (a file that is written otherwise in the listing is cut here)
        return df.join(names, "_at", "left").select(
            *[F.coalesce(f"_known_{k}", _file_key(path, k)).alias(k) for k in keys], *columns,
            F.coalesce("_known", path).alias("_path"))

    rows = named(reports.select("page", "row", "cells", at).where("cells is not null"), "page", "row", "cells")
    # few lines hold header lines: the others are told by their text (which may write a name by escapes), unparsed
    reader, paths = _files(spark, where, REPORT_SUFFIX)
    marked = F.col("value").contains("lines") | F.col("value").contains("\\u")
    # (``when``: Spark works out what several filters share before any of them, so it would parse every line)
    lines = reader.text(paths).select(
        F.when(marked, F.from_json("value", "lines array<string>")).alias("_r"), at).select("_r.lines", "_at")
    return rows, named(lines.where("lines is not null"), "lines").drop("_path")


def legacy_header_names(rows: DataFrame) -> DataFrame:
    """P1 on data: normalised header cells of each report (page 1, first row)."""
    first = rows.where((F.col("page") == 1) & (F.col("row") == 0))
    return first.select("index_name", "file", F.posexplode("cells").alias("position", "raw")).select(
        "index_name", "file", "position", "raw", normalize_name_col(F.col("raw")).alias("name")
    )


def header_review_dates(lines: DataFrame) -> DataFrame:
    """First 'last updated' line (any case) with an 8-digit or d.m.yyyy date."""
    ex = lines.select("index_name", "file", F.posexplode("lines").alias("pos", "line")).where(
        F.lower("line").contains("last updated")
    )
    d8 = F.try_to_date(F.regexp_extract("line", r"(\d{8})", 1), "yyyyMMdd")
    dmy = F.try_to_date(
        F.concat_ws(
            "-",
            F.regexp_extract("line", r"(\d{1,2})\.(\d{1,2})\.(\d{4})", 3),
            F.regexp_extract("line", r"(\d{1,2})\.(\d{1,2})\.(\d{4})", 2),
            F.regexp_extract("line", r"(\d{1,2})\.(\d{1,2})\.(\d{4})", 1),
        ),
        "yyyy-M-d",
    )
    dated = ex.withColumn("review_date", F.coalesce(d8, dmy)).where(F.col("review_date").isNotNull())
    return dated.groupBy("index_name", "file").agg(F.min_by("review_date", F.col("pos")).alias("review_date"))


# normalised names of the report dialect's columns
REPORT_FIELDS = ("isin", "int_key", "ric", "company_name", "country", "currency", "sedol", "ff_mcap_beur", "rank_final")


def _heading() -> Column:
    return (F.col("page") == 1) & (F.col("row") == 0)


def _report_rows(rows: DataFrame, every: bool = False) -> tuple[DataFrame, Column]:
    """Data rows with their report's normalised header, and a cell by its header name (from the right: of
    repeated header cells the last one counts).  With ``every``, header rows and rows without a header too."""
    header = rows.where(_heading()).select("index_name", "file", F.transform("cells", normalize_name_col).alias("header"))
    at = {name: F.when(F.array_contains("header", name),
                       F.size("header") - F.array_position(F.reverse("header"), name).cast("int"))
          for name in REPORT_FIELDS}
    header = header.select("index_name", "file", F.size("header").alias("_width"),
                           *[k.alias(f"_at_{name}") for name, k in at.items()])
    # one short row per report
    data = (rows if every else rows.where(~_heading())).join(
        F.broadcast(header), ["index_name", "file"], "left" if every else "inner")

    def cell(name: str) -> Column:
        return F.get("cells", F.col(f"_at_{name}"))

    return data.withColumn("ordinal", F.col("page").cast("long") * 1_000_000 + F.col("row")), cell


def _report_fields(cell) -> list[Column]:
    return [
        F.trim(cell("isin")).alias("isin"),
        F.trim(cell("int_key")).alias("internal_key"),
        F.trim(cell("ric")).alias("ric"),
        F.trim(cell("company_name")).alias("name"),
        F.trim(cell("country")).alias("country"),
        F.trim(cell("currency")).alias("currency"),
        _blank_null(cell("sedol")).alias("sedol"),
        (_blank_null(cell("ff_mcap_beur")).try_cast("double") * 1000).alias("ff_mcap"),
        _rank(cell("rank_final")).alias("rank"),
    ]


def normalise_legacy_reports(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows whose width equals the header's, blank ISINs dropped, BEUR x 1000."""
    data, cell = _report_rows(rows)
    path = ["_path"] if "_path" in rows.columns else []
    out = data.where(F.size("cells") == F.col("_width")).select(
        "index_name",
        "file",
        "page",
        "row",
        "ordinal",
        *_report_fields(cell),
        *path,
    ).where(F.col("isin").isNotNull() & (F.col("isin") != ""))
    return out.join(F.broadcast(header_review_dates(lines)), ["index_name", "file"], "left")


def legacy_assets(rows: DataFrame) -> DataFrame:
    """Assets of each report: the first row per ISIN."""
    return first_per_key(rows, ["index_name", "file", "isin"], ["ordinal"],
                         ["internal_key", "ric", "name", "country", "currency", "sedol"])


def legacy_rejects(rows: DataFrame) -> DataFrame:
    """What a report row says that cannot be used: another ``width`` than the header's or no ISIN
    (``identifier``; both leave the row out), an unreadable ``rank`` or market cap (``mcap``)."""
    data, cell = _report_rows(rows)
    return _rejected(data, _report_reasons(cell))


def _held(cell) -> Column:
    return (F.size("cells") == F.col("_width")) & _blank_null(cell("isin")).isNotNull()


def _report_reasons(cell) -> Reasons:
    fits, held = F.size("cells") == F.col("_width"), _held(cell)
    return {
        "width": (~fits, F.size("cells").cast("string")),
        "identifier": (fits & ~held, cell("int_key")),
        "rank": (held & _unread(cell("rank_final"), _rank(cell("rank_final")), "int"), cell("rank_final")),
        "mcap": (held & _unread(cell("ff_mcap_beur"), _blank_null(cell("ff_mcap_beur")).try_cast("double"), "double"),
                 cell("ff_mcap_beur")),
    }


def legacy_dates(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Per report its review date (null: none found in the header lines) and how many it has."""
    files = rows.select("index_name", "file").distinct().join(header_review_dates(lines), ["index_name", "file"], "left")
    return files.select("index_name", "file", "review_date", F.col("review_date").isNotNull().cast("long").alias("dates"))


# ------------------------------------------------------------- both dialects


# values that seldom repeat in a list: Parquet's dictionaries of them would be built and thrown away
OWN_TEXTS = {f"parquet.enable.dictionary#{c}": "false" for c in (
    "internal_key", "isin", "ric", "name", "sedol", "ff_mcap", "rank", "ordinal")}
LIST_ROW = ("index_name", "file", "dialect", "review_date", "internal_key", "isin", "ric", "name", "country", "currency",
            "sedol", "ff_mcap", "rank", "comment", "_path", "ordinal")


@dataclass(frozen=True)
class Lists:
    """``rows``: clean list rows of both dialects; ``rejects``: REJECT_COLUMNS; ``dates``: per file.

    ``parsed`` holds all three in one frame (``parsed_lists``), for who needs them all.
    """

    rows: DataFrame
    rejects: DataFrame
    dates: DataFrame
    parsed: DataFrame | None = None

    def once(self) -> Lists:
        """The same lists, parsed once: each part reads a staged copy and no list file."""
        if self.parsed is None:
            return replace(self, rows=staged(self.rows, "list-rows", OWN_TEXTS))
        parsed = staged(self.parsed, "list-rows", OWN_TEXTS)
        csv = parsed.where("dialect = 'csv'").groupBy("_path").agg(
            F.max("review_date").alias("review_date"), F.countDistinct("day").alias("dates")).select(
            _file_key(F.col("_path"), "index_name").alias("index_name"), _file_key(F.col("_path"), "file").alias("file"),
            "review_date", "dates")
        old = parsed.where("dialect = 'legacy'").groupBy("index_name", "file").agg(
            F.max("review_date").alias("review_date")).withColumn("dates", F.col("review_date").isNotNull().cast("long"))
        return Lists(
            parsed.where("held").select(*LIST_ROW),
            parsed.where("faults is not null").select("index_name", "file", "ordinal", F.inline("faults")),
            csv.unionByName(old),
            parsed,
        )


def parsed_lists(scan: DataFrame, lookup: DataFrame | None, tables: DataFrame, lines: DataFrame) -> DataFrame:
    """Every row of both dialects with LIST_ROW, ``held`` (a list row), ``faults`` (null: none) and the ``day`` that
    a CSV row names.  Of a report also the rows that are neither list rows nor faulty, as they tell that it is there."""
    reasons = _csv_reasons()
    csv = normalise_csv_lists(scan.withColumns({
        "faults": F.when(_faulty(reasons), _faults(reasons)), "day": _day(F.col("creation_date"))}), lookup)
    data, cell = _report_rows(tables, every=True)
    reasons = _report_reasons(cell)
    old = data.select(
        "index_name", "file", *_report_fields(cell), "_path", "ordinal", (~_heading() & _held(cell)).alias("held"),
        F.when(~_heading() & _faulty(reasons), _faults(reasons)).alias("faults"),
    ).join(F.broadcast(header_review_dates(lines)), ["index_name", "file"], "left")
    none = F.lit(None)
    return csv.withColumns({"ordinal": F.col("_place"), "dialect": F.lit("csv"), "held": F.lit(True)}).select(
        *LIST_ROW, "held", "faults", "day").unionByName(old.withColumns({
            "dialect": F.lit("legacy"), "comment": none.cast("string"), "day": none.cast("date")}).select(
            *LIST_ROW, "held", "faults", "day"))


def read_lists(spark: SparkSession, where: str | list[str], lookup: DataFrame | None = None) -> Lists:
    """S3: the lists of a folder (or of some paths), each read in the dialect of its suffix.

    Missing ISINs of CSV lists are looked up; report rows without one are left out (and rejected).
    """
    scan = read_csv_lists(spark, where, once=True)
    tables, lines = read_legacy_reports(spark, where)
    csv = normalise_csv_lists(scan, lookup).withColumn("ordinal", F.col("_place")).withColumn("dialect", F.lit("csv"))
    old = normalise_legacy_reports(tables, lines).withColumn("dialect", F.lit("legacy")).withColumn(
        "comment", F.lit(None).cast("string"))
    return Lists(
        csv.select(*LIST_ROW).unionByName(old.select(*LIST_ROW)),
        csv_rejects(scan).unionByName(legacy_rejects(tables)),
        csv_dates(scan).unionByName(legacy_dates(tables, lines)),
        parsed_lists(scan, lookup, tables, lines),
    )
