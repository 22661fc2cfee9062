"""Review calendar, publication keys and publication matching.

A calendar is driver-side configuration (default review months plus a table
of irregular years), inlined as literal maps: expanding it never touches data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReviewCalendar:
    default_months: tuple[int, ...]
    exceptions: dict[int, tuple[int, ...]] = field(default_factory=dict)
    # Periods from this month on are published as CSV and searched day by day
    # up to the next quarterly month; earlier ones as one report per month.
    csv_cutoff: str = "2023-12-01"
    quarterly_months: tuple[int, ...] = (3, 6, 9, 12)

    def months_col(self, year: Column) -> Column:
        default = F.array(*[F.lit(m) for m in self.default_months])
        if not self.exceptions:
            return default
        table = F.create_map(
            *[x for y, ms in sorted(self.exceptions.items()) for x in (F.lit(y), F.array(*[F.lit(m) for m in ms]))]
        )
        return F.coalesce(F.element_at(table, year), default)

    def next_quarterly_col(self, month: Column) -> Column:
        """First quarterly month after ``month``; wraps to the first one."""
        expr = F.lit(min(self.quarterly_months))
        for q in sorted(self.quarterly_months, reverse=True):
            expr = F.when(month < q, F.lit(q)).otherwise(expr)
        return expr


# Fixed values of the reviewed index's calendar: irregular years, then the
# quarterly default; first period October 2015; CSV lists from December 2023.
VENDOR_CALENDAR = ReviewCalendar(
    default_months=(3, 6, 9, 12),
    exceptions={
        2015: (10, 11),
        2016: (2, 5, 8, 11),
        2017: (2, 5, 8, 11),
        2018: (2, 5, 11),
        2019: (2, 5, 8, 11),
        2020: (2, 5, 8, 11),
    },
    csv_cutoff="2023-12-01",
)
VENDOR_START = "2015-10-01"

# Calendar of the derived indexes: reviews at quarter starts; the first
# quarter of 1995 was not a review period; CSV lists from December 1999.
DERIVED_CALENDAR = ReviewCalendar(default_months=(1, 4, 7, 10), exceptions={1995: (4, 7, 10)}, csv_cutoff="1999-12-01")


def review_periods(spans: DataFrame, cal: ReviewCalendar) -> DataFrame:
    """(index_name, year, month, period_date) for each index's [start, end].

    ``spans`` has one row per index (index_name, start, end).  A period is kept
    when its first day lies in [first of start's month, end].
    """
    years = spans.select(
        "index_name", "start", "end", F.explode(F.sequence(F.year("start"), F.year("end"))).alias("year")
    )
    months = years.select("index_name", "start", "end", "year", F.explode(cal.months_col(F.col("year"))).alias("month"))
    dated = months.withColumn("period_date", F.make_date("year", "month", F.lit(1)))
    return dated.where(
        (F.col("period_date") >= F.trunc("start", "month")) & (F.col("period_date") <= F.col("end"))
    ).select("index_name", "year", "month", "period_date")


def publication_keys(periods: DataFrame, cal: ReviewCalendar, day: Column | None = None) -> DataFrame:
    """dialect, folder and file key of each period (CSV keys carry a day)."""
    d = day if day is not None else F.col("period_date")
    symbol = F.lower(F.col("index_name"))
    is_csv = F.col("period_date") >= F.lit(cal.csv_cutoff).cast("date")
    # Fixed key formats: report per month, CSV per publication day.
    key = F.when(
        is_csv, F.concat(F.lit("slpublic_"), symbol, F.lit("_"), F.date_format(d, "yyyyMMdd"), F.lit(".csv"))
    ).otherwise(F.concat(F.lit("sl_"), symbol, F.lit("_"), F.date_format("period_date", "yyyyMM"), F.lit(".pdf")))
    folder_day = F.when(is_csv, d).otherwise(F.col("period_date"))
    return periods.select(
        "*",
        F.when(is_csv, F.lit("csv")).otherwise(F.lit("legacy")).alias("dialect"),
        F.concat(F.year(folder_day).cast("string"), F.lit("/"), F.date_format(folder_day, "MMMM")).alias("folder"),
        key.alias("file_key"),
    )


def _windows(periods: DataFrame, cal: ReviewCalendar) -> DataFrame:
    """Periods with ``window_end``: the first month in which their list is not looked for any more.

    CSV periods search from the period month up to (not including) the next
    quarterly month of the same year (December: December only); older
    periods look in their own month.
    """
    m = F.col("month")
    nq = cal.next_quarterly_col(m)
    is_csv = F.col("period_date") >= F.lit(cal.csv_cutoff).cast("date")
    end_month = F.when(is_csv & (nq > m), nq).otherwise(m + 1)
    return periods.withColumn("window_end", F.add_months(F.col("period_date"), (end_month - m).cast("int")))


def _hits(windows: DataFrame, dates: DataFrame, date_col: str) -> DataFrame:
    """(index_name, period_date, date): each date with the periods whose window holds it; calendar-sized."""
    w = windows.select(F.col("index_name").alias("_idx"), "period_date", "window_end")
    return dates.join(
        w,
        (F.col("index_name") == F.col("_idx"))
        & (F.col(date_col) >= F.col("period_date"))
        & (F.col(date_col) < F.col("window_end")),
        "inner",
    ).drop("_idx", "window_end")


def match_publications(periods: DataFrame, publications: DataFrame, cal: ReviewCalendar) -> DataFrame:
    """First publication of each period inside its search window; else missed.

    Publications are first reduced to one row per (index, month) with a map-side partial aggregate, so
    the range join runs on two calendar-sized tables.
    """
    monthly = publications.groupBy("index_name", F.trunc("pub_date", "month").alias("pub_month")).agg(
        F.min("pub_date").alias("first_pub")
    )
    windows = _windows(periods, cal)
    hits = _hits(windows, monthly, "pub_month").groupBy("index_name", "period_date").agg(
        F.min("first_pub").alias("pub_date"))
    out = windows.join(hits, ["index_name", "period_date"], "left")
    keyed = publication_keys(out.select("index_name", "year", "month", "period_date", "pub_date"), cal, F.col("pub_date"))
    return keyed.select(
        "index_name",
        "year",
        "month",
        "period_date",
        "pub_date",
        "dialect",
        F.when(F.col("pub_date").isNotNull(), F.col("folder")).alias("folder"),
        F.when(F.col("pub_date").isNotNull(), F.col("file_key")).alias("file_key"),
        F.when(F.col("pub_date").isNotNull(), F.lit("downloaded")).otherwise(F.lit("missed")).alias("status"),
    )


def periods_of_reviews(periods: DataFrame, reviews: DataFrame, cal: ReviewCalendar) -> DataFrame:
    """Q15: each published review with the period that it closes: the latest one whose window holds its
    date, so a list of April can close March.  A review in no window closes none (null)."""
    hits = _hits(_windows(periods, cal), reviews.select("index_name", "review_date").distinct(), "review_date")
    closed = hits.groupBy("index_name", "review_date").agg(F.max("period_date").alias("period_date"))
    return reviews.select("index_name", "review_date").distinct().join(closed, ["index_name", "review_date"], "left")


def open_periods(periods: DataFrame, reviews: DataFrame, cal: ReviewCalendar) -> DataFrame:
    """Expected periods that no published review closes."""
    closed = periods_of_reviews(periods, reviews, cal).where(F.col("period_date").isNotNull())
    return periods.join(closed.select("index_name", "period_date").distinct(), ["index_name", "period_date"],
                        "left_anti").select(*periods.columns)
