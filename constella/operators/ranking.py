"""Ranking time series: exit sentinels, daily forward fill, wide export, checks.

The reviewed pipeline builds a wide (date x RIC) table, forward-fills it and
turns an exit sentinel 0 into null.  Here the table stays long:

* ``rank_events`` (W6): the rank of a RIC's first member row at each review, and
  0 at the review at which it has left.
* ``ranking_daily`` (W7): a member rank holds from its review to the day
  before the index's next review (or ``as_of``).  Only member events are
  expanded, so the wide fill's all-pairs grid is never built; the result has
  exactly the non-null cells of the wide table.
* ``ranking_wide`` (W8) has one map RIC -> rank per index and day, for export.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from constella.functions.ranking import calendar_sized
from constella.operators.intervals import first_per_key

KEY = ["index_name", "review_date"]


def data_reviews(entries: DataFrame, membership: DataFrame) -> DataFrame:
    """Reviews that have both entries and at least one member (others are skipped)."""
    has_members = membership.where(F.col("is_member")).select(*KEY).distinct()
    return entries.select(*KEY).distinct().join(has_members, KEY, "left_semi")


def member_ranks(entries: DataFrame, membership: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Per (index, review, ric) the rank of the first entry row whose ISIN is a member.

    With ``assets`` (J6) an entry without RIC takes its ISIN's from there; only members' rows are looked up.
    """
    members = membership.where(F.col("is_member")).select(*KEY, "isin").distinct()
    rows = entries.select(*KEY, "isin", "ric", "rank", "ordinal").join(members, [*KEY, "isin"], "left_semi")
    if assets is not None:
        listed = assets.select("index_name", "isin", F.col("ric").alias("_ric")).join(
            members.select("index_name", "isin"), ["index_name", "isin"], "left_semi")
        rics = first_per_key(listed, ["index_name", "isin"], ["_ric"], ["_ric"])
        rows = rows.join(rics, ["index_name", "isin"], "left").withColumn("ric", F.coalesce("ric", "_ric")).drop("_ric")
    rows = rows.where(F.col("ric").isNotNull())
    first = first_per_key(rows, [*KEY, "ric"], ["ordinal", "isin"], ["rank"])
    # A member without rank counts as an exit (0), not as "keep the old rank".
    return first.withColumn("rank", F.coalesce(F.col("rank"), F.lit(0)))


def rank_events(entries: DataFrame, membership: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """(index, review, ric, rank) of every member row, and rank 0 at the review a RIC left.

    Only changes are kept: a RIC that stays out has no further rows, so the
    output grows with the membership, not with RICs x reviews.
    """
    w = Window.partitionBy("index_name").orderBy("review_date")
    following = data_reviews(entries, membership).withColumn("next_review", F.lead("review_date").over(w))
    ranks = member_ranks(entries, membership, assets).select(*KEY, "ric", F.col("rank").cast("int").alias("rank"))
    exits = (
        ranks.where(F.col("rank") > 0)
        .join(calendar_sized(following.where(F.col("next_review").isNotNull())), KEY, "inner")
        .select("index_name", F.col("next_review").alias("review_date"), "ric")
        .join(ranks.select(*KEY, "ric"), [*KEY, "ric"], "left_anti")
    )
    return ranks.unionByName(exits.withColumn("rank", F.lit(0)))


def review_spans(reviews: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Each review's validity: [review_date, next review - 1], the last one up to ``as_of``."""
    w = Window.partitionBy("index_name").orderBy("review_date")
    nxt = F.lead("review_date").over(w)
    return reviews.select(
        *KEY, F.coalesce(F.date_sub(nxt, 1), F.lit(as_of).cast("date")).alias("valid_to")
    ).where(F.col("review_date") <= F.col("valid_to"))


def expand_daily(ranks: DataFrame, spans: DataFrame) -> DataFrame:
    """(index, date, ric, rank) for every day of the span of a rank's review."""
    return ranks.where(F.col("rank") > 0).join(calendar_sized(spans), KEY, "inner").select(
        "index_name",
        F.explode(F.sequence("review_date", "valid_to")).alias("date"),
        "ric",
        F.col("rank").cast("int").alias("rank"),
    )


def expand_on(ranks: DataFrame, spans: DataFrame, days: DataFrame) -> DataFrame:
    """``expand_daily`` restricted to given days (index_name, date), without expanding every day.

    ``days`` is calendar-sized (e.g. the review dates).  Each day is matched to the span that covers it
    (a range join of two calendar-sized tables), then ranks join on (index, review).
    """
    wanted = days.select(F.col("index_name").alias("_i"), F.col("date"))
    covering = calendar_sized(spans).join(
        calendar_sized(wanted),
        (F.col("index_name") == F.col("_i")) & (F.col("date") >= F.col("review_date")) & (F.col("date") <= F.col("valid_to")),
        "inner",
    ).select(*KEY, "date")
    return ranks.where(F.col("rank") > 0).join(calendar_sized(covering), KEY, "inner").select(
        "index_name", "date", "ric", F.col("rank").cast("int").alias("rank")
    )


def ranking_daily(entries: DataFrame, membership: DataFrame, as_of: dt.date | str) -> DataFrame:
    """(index, date, ric, rank) for every day a RIC holds a member rank."""
    return expand_daily(member_ranks(entries, membership), review_spans(data_reviews(entries, membership), as_of))


def ranking_on(entries: DataFrame, membership: DataFrame, days: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The daily ranking restricted to given days (index_name, date)."""
    spans = review_spans(data_reviews(entries, membership), as_of)
    return expand_on(member_ranks(entries, membership), spans, days)


def ranked_per_day(entries: DataFrame, membership: DataFrame, as_of: dt.date | str) -> DataFrame:
    """V5: number of ranked RICs on every day, without expanding each RIC.

    The count is constant over a review's span, so counts per review are
    expanded to days instead of member ranks (``target`` times fewer rows).
    """
    spans = review_spans(data_reviews(entries, membership), as_of)
    counts = member_ranks(entries, membership).where(F.col("rank") > 0).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("ranked")
    )
    return counts.join(calendar_sized(spans), KEY, "inner").select(
        "index_name", F.explode(F.sequence("review_date", "valid_to")).alias("date"), "ranked"
    )


def ranking_wide(entries: DataFrame, membership: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One row per (index, date) with every ranked RIC in a map RIC -> rank.

    A map has at most ``target`` entries, so no RIC list is collected and no
    column limit applies.  It is built once per review, then expanded to days.
    """
    spans = review_spans(data_reviews(entries, membership), as_of)
    ranks = member_ranks(entries, membership).where(F.col("rank") > 0)
    cells = ranks.groupBy(*KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("ric", F.col("rank").cast("int").alias("rank"))))).alias("ranks"))
    return cells.join(calendar_sized(spans), KEY, "inner").select(
        "index_name", F.explode(F.sequence("review_date", "valid_to")).alias("date"), "ranks"
    )


def rank_gaps(daily: DataFrame, reviews: DataFrame, check_to: int | dict) -> DataFrame:
    """V1: at each review date, are ranks 1..check_to all present?  Never raises.

    status: ``passed``, ``failed`` (with the count and the first ten missing
    ranks) or ``absent`` (no ranking row on that date).
    """
    at = daily.withColumnRenamed("date", "review_date").join(reviews.select(*KEY), KEY, "left_semi")
    limit = F.lit(check_to) if isinstance(check_to, int) else check_to
    expected = reviews.select(*KEY, F.explode(F.sequence(F.lit(1), limit)).alias("rank"))
    present = at.select(*KEY, "rank").distinct()
    missing = expected.join(present, [*KEY, "rank"], "left_anti").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("missing"),
        F.concat_ws(",", F.slice(F.array_sort(F.collect_list("rank")), 1, 10).cast("array<string>")).alias(
            "missing_first10"
        ),
    )
    found = present.groupBy(*KEY).agg(F.count(F.lit(1)).alias("distinct_ranks"))
    out = reviews.select(*KEY).join(found, KEY, "left").join(missing, KEY, "left")
    return out.select(
        *KEY,
        F.coalesce(F.col("missing"), F.lit(0)).cast("bigint").alias("missing"),
        F.coalesce(F.col("missing_first10"), F.lit("")).alias("missing_first10"),
        F.coalesce(F.col("distinct_ranks"), F.lit(0)).cast("bigint").alias("distinct_ranks"),
        F.when(F.col("distinct_ranks").isNull(), F.lit("absent"))
        .when(F.col("missing").isNull(), F.lit("passed"))
        .otherwise(F.lit("failed"))
        .alias("status"),
    )
