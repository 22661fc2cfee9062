"""Membership intervals (gaps and islands over the review calendar)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from constella.functions.ranking import calendar_sized


def review_index(reviews: DataFrame) -> DataFrame:
    """Dense 1-based index ``k`` of each review inside its index.

    Runs on the distinct reviews table only (one row per index and quarter),
    never on entries, so the window per index stays tiny.
    """
    w = Window.partitionBy("index_name").orderBy("review_date")
    return reviews.select("index_name", "review_date").distinct().withColumn("k", F.row_number().over(w))


def membership_intervals(membership: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per (index, isin, contiguous run of reviews).

    Contiguity is in the index's list of reviews (a review in which an ISIN is
    not a member, or that has no members at all, breaks the run), not in days.
    island = k - row_number() over (index, isin order by k) is constant along a
    run.  Shuffles once by (index, isin); the aggregate reuses that
    partitioning.  The reviews side is calendar-sized and broadcast.
    """
    members = membership.where(F.col("is_member")).select("index_name", "review_date", "isin").distinct()
    with_k = members.join(calendar_sized(review_index(reviews)), ["index_name", "review_date"], "inner")
    w = Window.partitionBy("index_name", "isin").orderBy("k")
    runs = with_k.withColumn("island", F.col("k") - F.row_number().over(w))
    return runs.groupBy("index_name", "isin", "island").agg(
        F.min("review_date").alias("first_included"), F.max("review_date").alias("last_included")
    ).drop("island")


def extend_intervals(
    published: DataFrame, members: DataFrame, reviews: DataFrame, since: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """W5 kept up to date: the intervals that change when the reviews from ``since`` on are new.

    ``members`` holds the membership of those reviews, ``since`` one row per index (index_name,
    review_date), ``reviews`` all reviews.  An interval that ended before the last review ahead of
    ``since`` stays as it is.  One that holds that review is cut there and goes on as a seed, next to
    the new rows.  Returns (the changed intervals, (index_name, review_date)): the rows replace all
    intervals whose last review is that date or later.
    """
    start = calendar_sized(since.select("index_name", F.col("review_date").alias("_since")))
    ahead = reviews.join(start, "index_name").where(F.col("review_date") < F.col("_since")).groupBy("index_name").agg(
        F.max("review_date").alias("_ahead"))
    seeds = published.join(calendar_sized(ahead), "index_name").where(
        (F.col("last_included") >= F.col("_ahead")) & (F.col("first_included") <= F.col("_ahead"))).select(
        "index_name", F.col("_ahead").alias("review_date"), "isin", "first_included")
    rows = members.where(F.col("is_member")).select("index_name", "review_date", "isin").distinct().withColumn(
        "first_included", F.col("review_date")).unionByName(seeds)
    with_k = rows.join(calendar_sized(review_index(reviews)), ["index_name", "review_date"], "inner")
    w = Window.partitionBy("index_name", "isin").orderBy("k")
    changed = with_k.withColumn("island", F.col("k") - F.row_number().over(w)).groupBy(
        "index_name", "isin", "island").agg(
        F.min("first_included").alias("first_included"), F.max("review_date").alias("last_included")).drop("island")
    place = since.select("index_name", "review_date").join(calendar_sized(ahead), "index_name", "left").select(
        "index_name", F.coalesce("_ahead", "review_date").alias("review_date"))
    return changed, place


def first_per_key(df: DataFrame, keys: list[str], order_cols: list, out_cols: list[str] | None = None) -> DataFrame:
    """A1: keep the first row per key in an explicit order (not dropDuplicates).

    ``min_by`` over a struct of the wanted columns: a partial aggregate that
    combines map-side, so a hot key never gathers its rows in one task.
    """
    out_cols = out_cols or [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*out_cols), order).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in out_cols])


def merge_snapshots(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A2: union with widening (missing columns null); the existing row wins per key."""
    derived = [c for c in ("first_included", "last_included", "entity_id") if c in existing.columns]
    old = existing.drop(*derived).withColumn("_src", F.lit(0))
    both = old.unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    if "_row" not in both.columns:
        both = both.withColumn("_row", F.lit(0).cast("bigint"))
    cols = [c for c in both.columns if c not in (*keys, "_src", "_row")]
    # Source priority, then input order; the row itself breaks exact ties.
    return first_per_key(both, keys, ["_src", "_row", *cols], cols)


def merge_listed(known: DataFrame, listed: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """A1 and A2 in one pass: the known row per key, else the first listed one by ``place``.

    Of several known rows the smallest counts.  A row is moved once, and the sort of the aggregate is led by a
    number that tells the keys apart: ``_spread`` stays in the result, for joins that go on from there.
    """
    old = known.drop("first_included", "last_included", "entity_id").withColumn("_src", F.lit(0))
    both = old.unionByName(listed.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (*keys, *place, "_src")]
    new = F.col("_src") == 1
    # one struct is order and row: of a listed row the place comes first, of a known one last
    row = F.struct("_src", *[F.when(new, F.col(c)).alias(f"_new_{c}") for c in place], *cols,
                   *[F.when(~new, F.col(c)).alias(f"_old_{c}") for c in place])
    first = both.groupBy(F.xxhash64(*keys).alias("_spread"), *keys).agg(F.min(row).alias("_first"))
    return first.select("_spread", *keys, *[F.col(f"_first.{c}").alias(c) for c in cols], *[
        F.coalesce(f"_first._new_{c}", f"_first._old_{c}").alias(c) for c in place])


def assets_with_intervals(intervals: DataFrame, metadata: DataFrame) -> DataFrame:
    """Intervals left-join asset metadata; one row per (isin, interval)."""
    return intervals.join(metadata, ["index_name", "isin"], "left")
