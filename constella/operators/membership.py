"""Index membership: positions, top-N and the buffer rule (single and chained).

Scale notes
-----------
* ``candidates`` keeps only positions <= buffer_end per review, and numbers no
  other row.  The filter on a literal bound lets Catalyst insert a partial
  ``WindowGroupLimit`` before the shuffle, so even a review that holds a third
  of all entries ships at most buffer_end rows per salt and map task.
* With a prior member set, the rule never looks beyond buffer_end: at most
  target-auto picks lie past ``auto``; retained ones lie <= buffer_end and
  fills <= target.  So the chained fold per index works on
  buffer_end x #reviews rows, a bound fixed by the rule and the calendar, not
  by the data volume.  Indexes are folded in parallel.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constella.functions.ranking import calendar_sized, ranked_within
from constella.functions.rules import max_rule, rule_col
from constella.schemas import (
    REASON_BOOTSTRAP,
    REASON_FILL,
    REASON_RETAINED,
    REASON_TOP,
    IndexRule,
)
from constella.session import staged

KEY = ["index_name", "review_date"]


def first_per_isin(entries: DataFrame) -> DataFrame:
    """One row per (index, review, isin): the first by ``ordinal`` (ranked rows only).

    An aggregate with ``min_by`` combines map-side before the shuffle.  Lists of
    one date from several files are ordered by (file, row).
    """
    place = F.struct("file", "ordinal") if "file" in entries.columns else F.col("ordinal")
    picked = entries.where(F.col("rank").isNotNull() & F.col("isin").isNotNull()).groupBy(*KEY, "isin").agg(
        F.min_by(F.struct("rank", "ordinal"), place).alias("_first")
    )
    return picked.select(*KEY, "isin", F.col("_first.rank").alias("rank"), F.col("_first.ordinal").alias("ordinal"))


def _ranked(entries: DataFrame, dedupe: bool) -> DataFrame:
    if dedupe:
        return first_per_isin(entries)
    return entries.where(F.col("rank").isNotNull() & F.col("isin").isNotNull()).select(*KEY, "isin", "rank")


def positions(entries: DataFrame, dedupe: bool = True) -> DataFrame:
    """1-based position of each ranked entry by (rank, isin) within its review.

    Every ranked row gets a position; the numbering deals rows evenly over tasks, so a large review is
    never one task.
    """
    ranked = ranked_within(_ranked(entries, dedupe), KEY, ["rank", "isin"], "position")
    return ranked.select(*KEY, "isin", "rank", "position")


def first_positions(rows: DataFrame, n: int, order: list[Column], salts: int | None = None) -> DataFrame:
    """``rows`` with ``position``, only the first ``n`` of each review in the total ``order``.

    Two stages: first ``n`` per (review, salt), each limited in the map task already, then first ``n`` of
    those.  There are as many salts as shuffle partitions, so a review of any size is spread over
    the cluster, and the last stage reads ``n`` rows per salt at most.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("isin"), F.lit(salts)))
    w1 = Window.partitionBy(*KEY, "_salt").orderBy(*order)
    salted = salted.withColumn("_p", F.row_number().over(w1)).where(F.col("_p") <= F.lit(n)).drop("_p", "_salt")
    w = Window.partitionBy(*KEY).orderBy(*order)
    return salted.withColumn("position", F.row_number().over(w)).where(F.col("position") <= F.lit(n))


def top_n(entries: DataFrame, n: int, dedupe: bool = True, salts: int | None = None) -> DataFrame:
    """The first ``n`` positions of every review."""
    order = [F.col("rank").asc(), F.col("isin").asc()]
    return first_positions(_ranked(entries, dedupe), n, order, salts).select(*KEY, "isin", "rank", "position")


def candidates(entries: DataFrame, rules: dict[str, IndexRule], dedupe: bool = True) -> DataFrame:
    """Positions 1..buffer_end of every review: all the rule ever needs."""
    bound = max_rule(rules, "buffer_end")
    top = top_n(entries, bound, dedupe)
    return top.where(F.col("position") <= rule_col(rules, "buffer_end")).select(*KEY, "isin", "position")


# rows of a review that are ranked at first, for each place that the rule needs, and how many times more if too
# many of them are second listings of their instrument
ROWS_A_PLACE, MORE = 2, 8
# (index, review, ISIN) rows up to which they are sent to all tasks
BROADCAST_ROWS = 1_000_000


def _grade(rank: Column) -> Column:
    """Ranks in some hundred steps, in their order."""
    size = F.floor(F.sqrt(F.sqrt(F.abs(rank.cast("double")))) * 4)
    return F.when(rank < 0, -size).otherwise(size).cast("int")


def leading_first(entries: DataFrame, rules: dict[str, IndexRule]) -> DataFrame:
    """``first_per_isin`` of every review, only as far down as the rule looks (whole steps of ``_grade``), staged.

    An instrument's first row may be far down its lists while a later one of it leads, so all rows of the
    instruments that have a leading row are compared, and no others.  What leads is taken from the counts of
    rows; if in a review too few instruments are first listed there, more rows lead, in the end all of them.
    """
    ranked = entries.where(F.col("rank").isNotNull() & F.col("isin").isNotNull()).withColumn("_grade", _grade(F.col("rank")))
    counts = staged(ranked.groupBy(*KEY, "_grade").agg(F.count(F.lit(1)).alias("_n")), "rank-counts")
    upto = Window.partitionBy(*KEY).orderBy("_grade")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    need = rule_col(rules, "buffer_end").cast("long")
    each = ROWS_A_PLACE
    while True:
        lead = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
            "_last", F.lead("_grade").over(upto).isNull()).where(F.col("_before") < need * each)
        ends = staged(lead.groupBy(*KEY).agg(
            F.max("_grade").alias("_end"), F.max("_last").alias("_whole"), F.sum("_n").alias("_rows")), "rank-ends")
        end = calendar_sized(ends.select(*KEY, "_end"))
        some = ranked.join(end, KEY).where(F.col("_grade") <= F.col("_end")).select(*KEY, "isin").distinct()
        if (ends.agg(F.sum("_rows")).first()[0] or 0) <= BROADCAST_ROWS:
            some = F.broadcast(some)
        first = first_per_isin(ranked.join(some, [*KEY, "isin"], "left_semi"))
        first = staged(first.join(end, KEY).where(_grade(F.col("rank")) <= F.col("_end")).drop("_end"), "leading")
        found = first.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_found"))
        short = ends.where(~F.col("_whole")).join(calendar_sized(found), KEY, "left").where(
            F.coalesce("_found", F.lit(0)) < need)
        if short.isEmpty():
            return first
        each *= MORE


def listed_candidates(rows: DataFrame, rules: dict[str, IndexRule], order: list[Column]) -> DataFrame:
    """``candidates`` of lists that carry no ranks yet: rows to rank in a total ``order`` (ISINs unique per
    review), all columns kept.  The position is the rank, and no other row is numbered."""
    top = first_positions(rows, max_rule(rules, "buffer_end"), order)
    return top.where(F.col("position") <= rule_col(rules, "buffer_end"))


def apply_buffer_rule(
    cands: DataFrame,
    prior: DataFrame | None,
    rules: dict[str, IndexRule],
    prior_reviews: DataFrame | None = None,
) -> DataFrame:
    """Membership of each review given the prior member set of that review.

    ``prior`` has (index_name, review_date, isin): the members that count as
    prior *for* ``review_date``.  A review is a bootstrap (top ``target``)
    unless it has a prior; ``prior_reviews`` (index_name, review_date) lists
    reviews whose prior is given even if empty, else reviews with prior rows
    count.  Relational form: one window spec, no fold.
    """
    auto, target, end = (rule_col(rules, f) for f in ("auto", "target", "buffer_end"))
    if prior is None and prior_reviews is None:
        c = cands.withColumn("in_prior", F.lit(False)).withColumn("has_prior", F.lit(False))
    else:
        if prior is None:
            prior = cands.sparkSession.createDataFrame([], "index_name string, review_date date, isin string")
        flags = prior.select(*KEY, "isin").distinct().withColumn("in_prior", F.lit(True))
        given = prior_reviews if prior_reviews is not None else prior
        has = given.select(*KEY).distinct().withColumn("has_prior", F.lit(True))
        c = (
            cands.join(flags, [*KEY, "isin"], "left")
            .join(calendar_sized(has), KEY, "left")
            .fillna(False, subset=["in_prior", "has_prior"])
        )
    by_pos = Window.partitionBy(*KEY).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*KEY)
    is_top = F.col("position") <= auto
    is_buf = (F.col("position") > auto) & (F.col("position") <= end) & F.col("in_prior")
    c = c.withColumn("n_top", F.least(auto, F.count(F.lit(1)).over(whole)))
    c = c.withColumn("retained", is_buf & (F.sum(is_buf.cast("int")).over(by_pos) <= target - F.col("n_top")))
    c = c.withColumn("n_ret", F.sum(F.col("retained").cast("int")).over(whole))
    chosen = is_top | F.col("retained")
    c = c.withColumn(
        "fill",
        ~chosen & (F.sum((~chosen).cast("int")).over(by_pos) <= target - F.col("n_top") - F.col("n_ret")),
    )
    reason = (
        F.when(~F.col("has_prior"), F.when(F.col("position") <= target, F.lit(REASON_BOOTSTRAP)))
        .when(is_top, F.lit(REASON_TOP))
        .when(F.col("retained"), F.lit(REASON_RETAINED))
        .when(F.col("fill"), F.lit(REASON_FILL))
    )
    return (
        c.withColumn("entry_reason", reason)
        .where(F.col("entry_reason").isNotNull())
        .select(*KEY, "isin", F.lit(True).alias("is_member"), "entry_reason")
    )


# ---------------------------------------------------------------- chained rule


def _review_lists(cands: DataFrame) -> DataFrame:
    """(index, review, c): the candidate ISINs of one review in position order."""
    return cands.groupBy(*KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "isin"))), lambda x: x["isin"]).alias("c")
    )


def _members_of(c: Column, prior: Column, auto: Column, target: Column, end: Column) -> Column:
    """Members of one review as array<struct<isin, reason>> (array functions only)."""
    bootstrap = prior.isNull()  # an empty prior set is a prior: the rule applies
    top = F.slice(c, 1, auto)
    zone = F.slice(c, auto + 1, F.greatest(end - auto, F.lit(0)))
    # array_intersect / array_except keep the order of their first argument.
    retained = F.slice(
        F.array_intersect(zone, F.coalesce(prior, F.array().cast("array<string>"))),
        1,
        F.greatest(target - F.size(top), F.lit(0)),
    )
    chosen = F.concat(top, retained)
    fill = F.slice(F.array_except(c, chosen), 1, F.greatest(target - F.size(chosen), F.lit(0)))

    def tag(arr: Column, reason: str) -> Column:
        return F.transform(arr, lambda x: F.struct(x.alias("isin"), F.lit(reason).alias("reason")))

    return F.when(bootstrap, tag(F.slice(c, 1, target), REASON_BOOTSTRAP)).otherwise(
        F.concat(tag(top, REASON_TOP), tag(retained, REASON_RETAINED), tag(fill, REASON_FILL))
    )


def chain_membership(
    cands: DataFrame,
    rules: dict[str, IndexRule],
    initial_prior: DataFrame | None = None,
    reviews: DataFrame | None = None,
) -> DataFrame:
    """The buffer rule chained review by review (prior of t = result of t-1).

    One JVM-side ``aggregate`` fold per index over its reviews in date order;
    the state is the previous member set (<= target ISINs).  ``initial_prior``
    (index_name, seed: array of ISINs, possibly empty) seeds the first review of
    an index (backfill); without it the first review bootstraps.  ``reviews``
    (index_name, review_date) adds reviews without a ranked row: they have no
    members, and the review after them has an empty prior.
    """
    auto, target, end = (rule_col(rules, f) for f in ("auto", "target", "buffer_end"))
    lists = _review_lists(cands)
    if reviews is not None:
        lists = reviews.select(*KEY).distinct().join(lists, KEY, "left").select(
            *KEY, F.coalesce("c", F.array().cast("array<string>")).alias("c")
        )
    per_index = lists.groupBy("index_name").agg(
        F.array_sort(F.collect_list(F.struct("review_date", "c"))).alias("reviews")
    )
    if initial_prior is not None:
        per_index = per_index.join(initial_prior.select("index_name", "seed"), "index_name", "left")
    else:
        per_index = per_index.withColumn("seed", F.lit(None).cast("array<string>"))

    out_type = "array<struct<review_date:date,members:array<struct<isin:string,reason:string>>>>"
    init = F.struct(F.col("seed").alias("prior"), F.array().cast(out_type).alias("out"))

    def step(acc: Column, r: Column) -> Column:
        members = _members_of(r["c"], acc["prior"], auto, target, end)
        review = F.struct(r["review_date"].alias("review_date"), members.alias("members"))
        return F.struct(
            F.transform(members, lambda m: m["isin"]).alias("prior"),
            F.concat(acc["out"], F.array(review)).alias("out"),  # one struct per review
        )

    folded = per_index.select("index_name", F.aggregate("reviews", init, step)["out"].alias("out"))
    return folded.select("index_name", F.inline("out")).select(*KEY, F.inline("members")).select(
        *KEY, "isin", F.lit(True).alias("is_member"), F.col("reason").alias("entry_reason")
    )


def membership_counts(membership: DataFrame, keys: Iterable[str] = ("index_name", "review_date")) -> DataFrame:
    """V5 helper: members per review."""
    return membership.where("is_member").groupBy(*keys).agg(F.count(F.lit(1)).alias("members"))


def rechained(
    cands: DataFrame,
    published: DataFrame,
    since: DataFrame,
    rules: dict[str, IndexRule],
    reviews: DataFrame,
) -> DataFrame:
    """Membership of the reviews from each index's earliest changed review on.

    ``since`` has one row per index (index_name, review_date); ``reviews`` lists all reviews, also those
    without a ranked row.  The prior of the first recomputed review is the published member set of the
    latest review before it (Q6: not the newest published one), which is empty if that review had no
    members.  ``since`` and ``reviews`` are calendar-sized, so every join here has a tiny side, and of
    the published membership only the prior review's partition is read.
    """
    start = F.broadcast(since.select("index_name", F.col("review_date").alias("_since")))
    known = reviews.select(*KEY).distinct().join(start, "index_name")
    last = known.where(F.col("review_date") < F.col("_since")).groupBy("index_name").agg(
        F.max("review_date").alias("review_date"))
    members = published.where(F.col("is_member")).select(*KEY, "isin").join(calendar_sized(last), KEY, "left_semi")
    # no earlier review: no row, hence a bootstrap; an earlier one without members: an empty seed
    prior = last.join(members, KEY, "left").groupBy("index_name").agg(F.collect_set("isin").alias("seed"))
    redo = cands.join(start, "index_name").where(F.col("review_date") >= F.col("_since")).drop("_since")
    later = known.where(F.col("review_date") >= F.col("_since")).drop("_since")
    return chain_membership(redo, rules, initial_prior=prior, reviews=later)


def rechain_from(
    cands: DataFrame,
    published: DataFrame,
    since: DataFrame,
    rules: dict[str, IndexRule],
    reviews: DataFrame | None = None,
) -> DataFrame:
    """The whole membership, recomputed from each index's earliest changed review on.

    Reviews before it, and indexes without one, keep their published rows.  Without ``reviews`` the
    reviews are those with candidates or published members.
    """
    if reviews is None:
        reviews = cands.select(*KEY).union(published.select(*KEY)).distinct()
    start = F.broadcast(since.select("index_name", F.col("review_date").alias("_since")))
    kept = published.join(start, "index_name", "left").where(
        F.col("_since").isNull() | (F.col("review_date") < F.col("_since")))
    return kept.select(*KEY, "isin", "is_member", "entry_reason").unionByName(
        rechained(cands, published, since, rules, reviews))
