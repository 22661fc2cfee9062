"""Registered queries: one per operator of the coverage list.

Each takes (spark, sf_dir) and returns a DataFrame over the whole input
tables.  Column names and types match the SQL twins in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from constella.functions import calendar as C
from constella.functions.ranking import calendar_sized, ranked_within
from constella.functions.rules import rule_col
from constella.operators import membership as M
from constella.operators import ranking as R
from constella.operators import resolve as X
from constella.operators.intervals import assets_with_intervals, first_per_key, merge_snapshots
from constella.operators.intervals import membership_intervals as membership_intervals_of
from constella.plans.book import AS_OF, ReviewBook, write_dialects
from constella.session import scratch_path, staged
from constella.sources import dataset as D
from constella.sources import derive as G
from constella.sources import selection as S
from constella.sources.dataset import ReviewDataset
from constella.sources.tables import read_table
from constella.streaming.incremental import start_list_stream

KEY = ["index_name", "review_date"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn=None, *, stage: tuple[str, ...] = ()):
    """Register a query.  ``stage`` names the shared frames the query uses
    more than once: staging (write + read back) only pays off for reuse.
    ``entries`` among them: the query reads the numbered lists."""

    def register(f: Callable[[ReviewBook], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(ReviewBook(spark, sf_dir, stage=stage))

        run.__name__ = f.__name__
        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        return run

    return register(fn) if fn is not None else register


# ------------------------------------------------------------------ membership


@query
def positions(b: ReviewBook) -> DataFrame:
    """Position of every ranked entry within its review.

    The lists carry no ranks until their rows are numbered, so one numbering gives rank and position.
    """
    numbered = ranked_within(b.listing.where("eligible"), KEY, G.rank_order(), "position")
    return numbered.select(*KEY, "isin", F.col("position").alias("rank"), "position")


@query
def listed_positions(b: ReviewBook) -> DataFrame:
    """W1 over lists that carry ranks with gaps and ties: positions by (rank, isin), first listing of an ISIN.

    Ranks are thinned to thirds, so that three entries share each; every tenth ISIN is listed again behind.
    """
    key = F.substring("isin", 3, 10).cast("bigint")
    tied = b.entries.withColumn("rank", F.ceil(F.col("rank") / 3).cast("int")).select(*KEY, "isin", "rank", "ordinal")
    again = tied.where(key % 10 == 0).withColumn("rank", F.lit(1)).withColumn("ordinal", F.col("ordinal") + 1_000_000_000)
    return M.positions(tied.unionByName(again))


@query
def top_n(b: ReviewBook) -> DataFrame:
    """The first ``target`` positions of each review."""
    top = M.first_positions(b.listing.where("eligible"), max(r.target for r in b.rules.values()), G.rank_order())
    return top.where(F.col("position") <= rule_col(b.rules, "target")).select(
        *KEY, "isin", F.col("position").alias("rank"), "position")


@query(stage=("candidates",))
def buffer_single(b: ReviewBook) -> DataFrame:
    """Rule for each review given a prior set: the previous review's top ``target``."""
    # target <= buffer_end (IndexRule), so the prior sets come from the same candidates.
    cands = b.candidates.select(*KEY, "isin", "position")
    tops = cands.where(F.col("position") <= rule_col(b.rules, "target"))
    w = Window.partitionBy("index_name").orderBy("review_date")
    following = b.reviews.withColumn("next_review", F.lead("review_date").over(w))
    prior = (
        tops.join(calendar_sized(following), KEY, "inner")
        .where(F.col("next_review").isNotNull())
        .select("index_name", F.col("next_review").alias("review_date"), "isin")
    )
    return M.apply_buffer_rule(cands, prior, b.rules)


@query
def buffer_chain(b: ReviewBook) -> DataFrame:
    """The chained rule (prior of each review = result of the previous one)."""
    return b.membership


def _middle(reviews: DataFrame) -> DataFrame:
    """The middle review of each index."""
    k = Window.partitionBy("index_name").orderBy("review_date")
    n = Window.partitionBy("index_name")
    ordered = reviews.select(*KEY, F.row_number().over(k).alias("k"), F.count(F.lit(1)).over(n).alias("n"))
    return ordered.where(F.col("k") == F.ceil(F.col("n") / 2)).select(*KEY)


@query(stage=("reviews",))
def chain_empty_review(b: ReviewBook) -> DataFrame:
    """A chain whose middle review ranks nobody; the review after it has an empty prior, no bootstrap."""
    some = b.candidates.join(calendar_sized(_middle(b.reviews)), KEY, "left_anti")
    return M.chain_membership(some, b.rules, reviews=b.reviews)


@query
def members_per_review(b: ReviewBook) -> DataFrame:
    """V5: members per review and whether the index is full."""
    counts = M.membership_counts(b.membership)
    return counts.select(*KEY, "members", (F.col("members") == rule_col(b.rules, "target")).alias("full"))


@query
def reason_counts(b: ReviewBook) -> DataFrame:
    """A3: members per entry reason at each review."""
    return b.membership.groupBy(*KEY, "entry_reason").agg(F.count(F.lit(1)).alias("members"))


@query
def ever_members(b: ReviewBook) -> DataFrame:
    """A10/T4: every ISIN that was ever a member."""
    return b.membership.where("is_member").select("index_name", "isin").distinct()


# --------------------------------------------------------------- constituents


def _constituents(b: ReviewBook, at: DataFrame | None) -> DataFrame:
    members = b.membership.where("is_member")
    if at is not None:
        members = members.join(calendar_sized(at), KEY, "left_semi")
    return members.join(b.assets, ["index_name", "isin"], "inner").select(
        *KEY, "isin", "entry_reason", "ric", "name", "country", "currency"
    )


@query
def constituents(b: ReviewBook) -> DataFrame:
    """Members joined with asset data, every review."""
    return _constituents(b, None)


@query
def latest_constituents(b: ReviewBook) -> DataFrame:
    """O1 + J1: constituents at the latest review of each index."""
    return _constituents(b, b.latest)


@query
def country_top10(b: ReviewBook) -> DataFrame:
    """A4/O3: top 10 countries by members at the latest review, with totals."""
    cons = _constituents(b, b.latest)
    counts = cons.groupBy("index_name", "country").agg(F.count(F.lit(1)).alias("members"))
    w = Window.partitionBy("index_name").orderBy(F.col("members").desc(), F.col("country").asc_nulls_last())
    whole = Window.partitionBy("index_name")
    ranked = counts.select(
        "index_name",
        "country",
        "members",
        F.row_number().over(w).alias("place"),
        F.count(F.lit(1)).over(whole).alias("countries"),
        F.sum("members").over(whole).alias("total_members"),
    )
    return ranked.where(F.col("place") <= 10)


# ------------------------------------------------------------------- intervals


@query
def islands(b: ReviewBook) -> DataFrame:
    """Contiguous membership intervals per ISIN."""
    return b.intervals


@query
def review_dates(b: ReviewBook) -> DataFrame:
    """Available review dates of each index."""
    return b.reviews


@query
def review_sizes(b: ReviewBook) -> DataFrame:
    """Entries and ranked entries per review."""
    return b.listing.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("entries"), F.count_if("eligible").alias("ranked")
    )


# --------------------------------------------------------------------- ranking
# Members are candidates, and a candidate's position is its rank: no other row is numbered.


@query(stage=("candidates", "membership"))
def rank_events(b: ReviewBook) -> DataFrame:
    """Ranks of member rows, and the exit sentinel 0 at the review a RIC left."""
    return R.rank_events(b.candidates, b.membership)


@query(stage=("candidates", "membership"))
def rank_events_backfilled(b: ReviewBook) -> DataFrame:
    """J6 inside W6: lists before 1998 carry no RIC; the ranking takes it from the assets."""
    old = F.col("review_date") < F.lit("1998-01-01").cast("date")
    lists = b.candidates.withColumn("ric", F.when(~old, F.col("ric")))
    return R.rank_events(lists, b.membership, b.assets)


@query(stage=("candidates", "membership"))
def ranking_daily(b: ReviewBook) -> DataFrame:
    """Forward-filled daily member ranks (long form, nulls absent)."""
    return R.ranking_daily(b.candidates, b.membership, AS_OF)


@query(stage=("candidates", "membership"))
def ranking_at(b: ReviewBook) -> DataFrame:
    """P10: the daily ranking on review dates (only those days are computed)."""
    return R.ranking_on(b.candidates, b.membership, b.reviews.withColumnRenamed("review_date", "date"), AS_OF)


@query(stage=("candidates", "membership"))
def ranking_wide(b: ReviewBook) -> DataFrame:
    """Wide export of both indexes: every RIC's rank per day, as sorted text."""
    wide = R.ranking_wide(b.candidates, b.membership, AS_OF)
    cell = lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    return wide.select("index_name", "date", F.array_join(F.transform(
        F.array_sort(F.map_entries("ranks")), cell), ",").alias("ranks"))


@query(stage=("candidates", "membership", "reviews"))
def rank_gaps(b: ReviewBook) -> DataFrame:
    """V1: ranks 1..check_to present at each review date of the daily ranking."""
    at_reviews = R.ranking_on(b.candidates, b.membership, b.reviews.withColumnRenamed("review_date", "date"), AS_OF)
    return R.rank_gaps(at_reviews, b.reviews, rule_col(b.rules, "check_to"))


@query(stage=("candidates", "membership"))
def members_per_day(b: ReviewBook) -> DataFrame:
    """V5: ranked RICs per day of the daily ranking (counts expanded, not RICs)."""
    return R.ranked_per_day(b.candidates, b.membership, AS_OF)


# ------------------------------------------------------------------ analytics


def _member_caps(b: ReviewBook) -> DataFrame:
    """Members with their market cap in integer cents (Q24: from entries)."""
    members = b.membership.where("is_member").select(*KEY, "isin")
    # members first: at most ``target`` rows of a review go through the keep-first step
    listed = b.candidates.where(F.col("ff_mcap").isNotNull()).join(members, [*KEY, "isin"], "left_semi")
    caps = first_per_key(listed, [*KEY, "isin"], ["ordinal"], ["ff_mcap"])
    return caps.withColumn(
        "cents", F.round(F.col("ff_mcap") * 100).cast("bigint")
    )


@query(stage=("candidates",))
def mcap_stats(b: ReviewBook) -> DataFrame:
    """A5: median / mean / max market cap of members per review."""
    caps = _member_caps(b)
    return caps.groupBy(*KEY).agg(
        (F.median("cents") / 100).alias("median_mcap"),
        (F.sum("cents").cast("double") / F.count(F.lit(1)) / 100).alias("mean_mcap"),
        F.max("ff_mcap").alias("max_mcap"),
    )


@query(stage=("candidates", "membership"))
def mcap_histogram(b: ReviewBook) -> DataFrame:
    """50-bin histogram of member market caps per review (max falls in bin 50)."""
    caps = _member_caps(b)
    bounds = caps.groupBy(*KEY).agg(F.min("cents").alias("lo"), F.max("cents").alias("hi"))
    binned = caps.join(calendar_sized(bounds), KEY, "inner").select(
        *KEY,
        F.when(F.col("hi") == F.col("lo"), F.lit(1))
        .otherwise(
            F.least(
                F.floor((F.col("cents") - F.col("lo")).cast("double") * 50 / (F.col("hi") - F.col("lo"))).cast("int")
                + 1,
                F.lit(50),
            )
        )
        .alias("bin"),
    )
    return binned.groupBy(*KEY, "bin").agg(F.count(F.lit(1)).alias("members"))


@query(stage=("listing",))
def coverage_stats(b: ReviewBook) -> DataFrame:
    """Per index first review, row counts, unique ISINs, unranked rows, members."""
    e = b.listing.groupBy("index_name").agg(
        F.min("review_date").alias("first_review"),
        F.count(F.lit(1)).alias("entries"),
        F.countDistinct("isin").alias("unique_isins"),
        F.count_if(~F.col("eligible")).alias("unranked"),
    )
    m = b.membership.where("is_member").groupBy("index_name").agg(
        F.count(F.lit(1)).alias("member_rows"), F.countDistinct("isin").alias("ever_members")
    )
    return e.join(m, "index_name", "left")


@query
def entries_ranked(b: ReviewBook) -> DataFrame:
    """Ranked entries (sorted by rank within review)."""
    return (
        b.entries.where(F.col("rank").isNotNull())
        .select(*KEY, "isin", "ric", "ff_mcap", "rank")
        .orderBy(*KEY, "rank")
    )


@query
def dedup_first(b: ReviewBook) -> DataFrame:
    """A1: the first listing of each ISIN (earliest review, then list order)."""
    return first_per_key(
        b.entries, ["index_name", "isin"], ["review_date", "ordinal"], ["review_date", "rank", "ff_mcap"]
    )


# ---------------------------------------------------------------- data quality


@query(stage=("entries",))
def dq_rank_600(b: ReviewBook) -> DataFrame:
    """V3: per review, entries >= target and ranks 1..target all present."""
    target = rule_col(b.rules, "target")
    ranks = b.entries.where(F.col("rank").isNotNull()).select(*KEY, "rank").distinct()
    in_range = ranks.where((F.col("rank") >= 1) & (F.col("rank") <= target))
    present = in_range.groupBy(*KEY).agg(F.count(F.lit(1)).alias("present"))
    sizes = b.entries.groupBy(*KEY).agg(F.count(F.lit(1)).alias("entries"))
    out = sizes.join(present, KEY, "left").select(
        *KEY,
        "entries",
        (target - F.coalesce(F.col("present"), F.lit(0))).cast("bigint").alias("missing_ranks"),
    )
    return out.withColumn("ok", (F.col("entries") >= target) & (F.col("missing_ranks") == 0))


@query
def dq_keys(b: ReviewBook) -> DataFrame:
    """V4: ISINs duplicated in an assets snapshot; entry ISINs missing from it.

    Both snapshots are checked: the current one is clean, the previous one has duplicates and gaps.
    """
    listed = G.listed_isins(b.spark, b.sf_dir)
    names = listed.select("index_name").distinct()
    previous = G.previous_snapshot(b.spark, b.sf_dir, b.assets)
    reports = []
    for snapshot, assets in (("current", b.assets), ("previous", previous)):
        counts = assets.groupBy("index_name", "isin").agg(F.count(F.lit(1)).alias("n"))
        dup = counts.groupBy("index_name").agg(F.count_if(F.col("n") > 1).alias("duplicate_isins"))
        orphans = (
            listed.join(counts, ["index_name", "isin"], "left_anti")
            .groupBy("index_name")
            .agg(F.count(F.lit(1)).alias("orphan_isins"))
        )
        reports.append(names.join(dup, "index_name", "left").join(orphans, "index_name", "left").select(
            "index_name",
            F.lit(snapshot).alias("snapshot"),
            F.coalesce("duplicate_isins", F.lit(0)).alias("duplicate_isins"),
            F.coalesce("orphan_isins", F.lit(0)).alias("orphan_isins"),
        ))
    return reports[0].unionByName(reports[1])


# ---------------------------------------------------------------- the dataset


@query
def entries_with_ric(b: ReviewBook) -> DataFrame:
    """Entries with the first RIC per ISIN from the assets."""
    return D.entries_with_ric(b.entries, b.assets)


@query(stage=("entries",))
def write_roundtrip(b: ReviewBook) -> DataFrame:
    """Write assets/entries/membership partitioned, read entries back."""
    return b.dataset.table("entries")


@query(stage=("entries",))
def entries_at(b: ReviewBook) -> DataFrame:
    """Entries of the latest review of each index (partition-pruned read)."""
    return b.dataset.entries_at()


@query(stage=("entries",))
def membership_at(b: ReviewBook) -> DataFrame:
    """Membership of the latest review of each index."""
    return b.dataset.membership_at()


@query(stage=("entries",))
def assets_snapshot(b: ReviewBook) -> DataFrame:
    """The assets snapshot read back."""
    return b.dataset.assets()


@query(stage=("entries",))
def index_catalog(b: ReviewBook) -> DataFrame:
    """Indexes in the dataset with review counts."""
    return D.catalog(b.dataset)


@query(stage=("entries",))
def published_constituents(b: ReviewBook) -> DataFrame:
    """J1 over the published dataset: latest members with one asset row each."""
    return b.dataset.constituents()


# ------------------------------------------------------------------ resolution


def _lookup(b: ReviewBook) -> DataFrame:
    return X.isin_lookup(G.asset_history(b.spark, b.sf_dir, b.assets))


@query
def isin_lookup(b: ReviewBook) -> DataFrame:
    """internal_key -> ISIN from an earlier assets file (last valid row wins)."""
    return _lookup(b)


@query
def resolve_isin(b: ReviewBook) -> DataFrame:
    """Repaired ISIN of every selection-list row (raw, else lookup, else KEY_<key>)."""
    rows = G.selection_rows(b.listing, b.assets)
    out = X.resolve_isins(rows.select("index_name", "review_date", "internal_key", "raw_isin"), _lookup(b))
    return out.select("index_name", "review_date", "internal_key", "raw_isin", "isin")


def _entities(b: ReviewBook) -> DataFrame:
    return X.unnest_entities(G.entity_responses(b.spark, b.sf_dir, b.assets))


@query
def unnest_entities(b: ReviewBook) -> DataFrame:
    """Identity-service responses unnested to (endpoint, id, alpha_id)."""
    return _entities(b)


def _merged(b: ReviewBook) -> DataFrame:
    metadata = merge_snapshots(G.previous_snapshot(b.spark, b.sf_dir, b.assets), b.assets, ["index_name", "isin"])
    return b.stage(assets_with_intervals(b.intervals, metadata), "merged")


@query
def merge_assets(b: ReviewBook) -> DataFrame:
    """Intervals joined with merged asset metadata (existing rows win)."""
    return _merged(b)


@query(stage=("merged",))
def enrich_ids(b: ReviewBook) -> DataFrame:
    """Entity id by ISIN, then by RIC for unresolved ISINs; rows preserved."""
    return X.enrich_ids(_merged(b), _entities(b))


@query(stage=("merged",))
def enrich_counts(b: ReviewBook) -> DataFrame:
    """V6: rows before and after enrichment, resolved by ISIN, by RIC, and not, taken on one pass."""
    _, counts = X.enrich_counted(_merged(b), _entities(b))
    return b.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))


@query(stage=("merged",))
def semi_unresolved(b: ReviewBook) -> DataFrame:
    """Merged asset rows whose ISIN the ISIN lookup left unresolved."""
    merged = _merged(b)
    missing = X.unresolved_isins(merged, _entities(b))
    return merged.join(missing, ["index_name", "isin"], "left_semi").select("index_name", "isin", "ric")


@query(stage=("merged",))
def unresolved_report(b: ReviewBook) -> DataFrame:
    """V7: one row per ISIN without entity id, dates as text, sorted by ISIN."""
    return X.unresolved_report(X.enrich_ids(_merged(b), _entities(b)))


@query
def ric_backfill(b: ReviewBook) -> DataFrame:
    """Entries of the older form (no RIC column) get the RIC from the assets."""
    old = b.entries.where(F.col("review_date") < F.lit("1998-01-01").cast("date")).drop("ric")
    new = b.entries.where(F.col("review_date") >= F.lit("1998-01-01").cast("date"))
    rics = first_per_key(b.assets.select("index_name", "isin", "ric"), ["index_name", "isin"], ["ric"], ["ric"])
    filled = old.join(rics, ["index_name", "isin"], "left")
    return filled.unionByName(new).select(*KEY, "isin", "ric", "rank")


# -------------------------------------------------------------------- calendar


PUBLISHED_BEFORE = "2000-01-01"


def _periods(b: ReviewBook) -> DataFrame:
    spans = b.reviews.groupBy("index_name").agg(
        F.min("review_date").alias("start"), F.lit(AS_OF).cast("date").alias("end")
    )
    return C.review_periods(spans, C.DERIVED_CALENDAR)


@query
def review_calendar(b: ReviewBook) -> DataFrame:
    """expected review periods of each index from its first review to as_of."""
    return _periods(b)


@query
def publication_keys(b: ReviewBook) -> DataFrame:
    """dialect, folder and file key of every expected period."""
    return C.publication_keys(_periods(b), C.DERIVED_CALENDAR)


@query(stage=("reviews",))
def missing_periods(b: ReviewBook) -> DataFrame:
    """Expected periods that no published review closes (dataset published up to 1999)."""
    published = b.reviews.where(F.col("review_date") < F.lit(PUBLISHED_BEFORE).cast("date"))
    return C.open_periods(_periods(b), published, C.DERIVED_CALENDAR)


def _late(reviews: DataFrame) -> DataFrame:
    """Reviews published late: a list of the second quarter comes out in May, one of the fourth in December."""
    delay = F.when(F.month("review_date") == 4, 1).when(F.month("review_date") == 10, 2).otherwise(0)
    return reviews.withColumn("review_date", F.add_months("review_date", delay))


@query(stage=("reviews",))
def period_of_review(b: ReviewBook) -> DataFrame:
    """The period that each published review closes, for lists that come out late."""
    return C.periods_of_reviews(_periods(b), _late(b.reviews), C.DERIVED_CALENDAR)


@query(stage=("reviews",))
def missing_periods_late(b: ReviewBook) -> DataFrame:
    """J8/Q15 with lists that come out late: a list of May closes April where lists are looked for that long."""
    return C.open_periods(_periods(b), _late(b.reviews), C.DERIVED_CALENDAR)


@query
def match_publications(b: ReviewBook) -> DataFrame:
    """First publication inside each period's search window (order / ship days)."""
    orders = read_table(b.spark, b.sf_dir, "orders", ["o_orderdate"]).select(
        F.lit("CUST").alias("index_name"), F.to_date("o_orderdate").alias("pub_date")
    )
    ships = read_table(b.spark, b.sf_dir, "lineitem", ["l_shipdate"]).select(
        F.lit("PART").alias("index_name"), F.to_date("l_shipdate").alias("pub_date")
    )
    return C.match_publications(_periods(b), orders.unionByName(ships), C.DERIVED_CALENDAR)


# ------------------------------------------------------------- list dialects


LIST_COLUMNS = ["index_name", "review_date", "internal_key", "isin", "ric", "name", "country", "currency",
                "sedol", "ff_mcap", "rank"]


def _csv_rows(b: ReviewBook) -> DataFrame:
    return S.normalise_csv_lists(S.read_csv_lists(b.spark, b.csv_dir, once=True), _lookup(b))


@query
def sel_normalise(b: ReviewBook) -> DataFrame:
    """CSV selection lists read, normalised and ISIN-resolved."""
    return _csv_rows(b).select(*LIST_COLUMNS, "comment")


@query
def sel_quoted(b: ReviewBook) -> DataFrame:
    """Cells with line breaks, separators and quotes; files with a record over several lines among others."""
    key = F.col("internal_key").cast("bigint")
    text = F.when(key % 5 == 0, F.concat(F.lit('first; "quoted"\nsecond; line '), F.col("internal_key"))).when(
        key % 5 == 1, F.lit('a;b ""c""')).otherwise(F.col("comment"))
    even = F.quarter("review_date") % 2 == 0
    path = scratch_path(b.spark, "quoted-lists")
    S.write_csv_lists(b.selection_rows.withColumn("comment", F.when(even, text).otherwise(F.col("comment"))), path,
                      packed=True)
    return S.normalise_csv_lists(S.read_csv_lists(b.spark, path, once=True), _lookup(b)).select(*LIST_COLUMNS, "comment")


@query
def sel_assets(b: ReviewBook) -> DataFrame:
    """Assets of each CSV list (first row per internal key).

    Some keys are listed again under another name, before or after their own row; the first row wins.
    """
    rows = _csv_rows(b)
    key = F.col("internal_key").cast("bigint")
    copies = rows.withColumn("copy", F.explode(F.array_compact(F.array(
        F.lit("ROW"), F.when(key % 10 == 0, F.lit("EARLIER")), F.when(key % 9 == 0, F.lit("LATER"))))))
    rows = copies.withColumn("name", F.when(F.col("copy") == "ROW", F.col("name")).otherwise(F.col("copy"))).withColumn(
        "_block", F.when(F.col("copy") == "EARLIER", F.lit(-1)).when(
            F.col("copy") == "LATER", F.col("_block") + (1 << 48)).otherwise(F.col("_block")))
    return S.csv_assets(rows.drop("copy"), by_internal_key=True)


@query
def dq_review_date(b: ReviewBook) -> DataFrame:
    """V2: each CSV list carries exactly one review date; rows of some keys carry another one."""
    lists = S.read_csv_lists(b.spark, b.csv_dir)
    other = F.trim("internal_key").cast("bigint") % 499 == 0
    return S.csv_review_dates(lists.withColumn(
        "creation_date", F.when(other, F.lit("19000101")).otherwise(F.col("creation_date"))))


def _legacy(b: ReviewBook) -> DataFrame:
    rows, lines = S.read_legacy_reports(b.spark, b.legacy_dir)
    return S.normalise_legacy_reports(rows, lines)


@query
def sel_normalise_legacy(b: ReviewBook) -> DataFrame:
    """Extracted report rows: width check, blank ISINs dropped, BEUR -> MEUR."""
    return _legacy(b).select(*LIST_COLUMNS)


@query
def sel_assets_legacy(b: ReviewBook) -> DataFrame:
    """Assets of each report; ISIN texts that several rows share ('null') keep their first row."""
    return S.legacy_assets(_legacy(b))


@query
def header_dates(b: ReviewBook) -> DataFrame:
    """Review date of each report from its header lines."""
    _, lines = S.read_legacy_reports(b.spark, b.legacy_dir)
    return S.header_review_dates(lines)


@query
def norm_names(b: ReviewBook) -> DataFrame:
    """Normalised header names of every report."""
    rows, _ = S.read_legacy_reports(b.spark, b.legacy_dir)
    return S.legacy_header_names(rows)


# Names from when the six queries saw one side of the date cut only; they see all lists now.
for _name in ("sel_normalise", "sel_assets", "dq_review_date", "sel_normalise_legacy", "header_dates", "norm_names"):
    QUERIES[f"{_name}_whole"] = QUERIES[_name]


@query
def sel_union_dialects(b: ReviewBook) -> DataFrame:
    """Entries of both dialects, read from one folder by their suffix."""
    lists = S.read_lists(b.spark, b.lists_dir, _lookup(b))
    return lists.rows.select("index_name", "review_date", "isin", "ff_mcap", "rank", "dialect")


@query
def list_rejects(b: ReviewBook) -> DataFrame:
    """Rows of both dialects that cannot be used as they are, by file, place and reason.

    Some keys get an unreadable rank or market cap, no creation date, or neither ISIN nor key.
    """
    scan = S.read_csv_lists(b.spark, b.csv_dir)
    key = F.trim("internal_key").cast("bigint")
    bad = scan.withColumns({
        "rank_final": F.when(key % 53 == 0, F.lit("n/a")).otherwise(F.col("rank_final")),
        "ff_mcap_meur": F.when(key % 59 == 0, F.lit("1,5")).otherwise(F.col("ff_mcap_meur")),
        "creation_date": F.when(key % 61 == 0, F.lit(" ")).otherwise(F.col("creation_date")),
        "internal_key": F.when(key % 34 == 0, F.lit(" ")).otherwise(F.col("internal_key")),
    })
    tables, _ = S.read_legacy_reports(b.spark, b.legacy_dir)
    return S.csv_rejects(bad).unionByName(S.legacy_rejects(tables))


@query
def same_date_lists(b: ReviewBook) -> DataFrame:
    """Each review comes as two files of one date that share some instruments; the first listing counts.

    The second file repeats every fifth instrument of the first one with rank 1.
    """
    rows, k = b.selection_rows.withColumn("raw_isin", F.col("isin")), F.col("ordinal")
    path = scratch_path(b.spark, "same-date-lists")
    # both files in one write: the rows meet their instruments once
    both = rows.withColumn("copy", F.explode(F.array_compact(F.array(
        F.when(k % 2 == 1, F.lit("a")), F.when((k % 2 == 0) | (k % 5 == 0), F.lit("b"))))))
    S.write_csv_lists(both.withColumn("rank", F.when((F.col("copy") == "b") & (k % 2 == 1), F.lit(1)).otherwise(
        F.col("rank"))), path, within=("copy",), packed=True)
    lists = S.read_lists(b.spark, path).rows.withColumnRenamed("_path", "file_")
    first = M.first_per_isin(lists.drop("file").withColumnRenamed("file_", "file"))
    counts = lists.groupBy(*KEY).agg(F.countDistinct("file_").alias("files"), F.count(F.lit(1)).alias("rows"))
    return counts.join(first.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("ranked"), F.sum(F.col("rank").cast("long")).alias("rank_sum")), KEY, "left")


# ----------------------------------------------------------------- incremental


WAVES = ("1997-01-01", "1999-12-01")
LATE_REVIEW = "2000-04-01"


def _synced(b: ReviewBook) -> ReviewDataset:
    """Lists of both dialects arrive in three waves, one review late; each stream run takes the new files only.

    ISIN texts are blank in some of an instrument's lists: a CSV list then takes the ISIN published
    before, if there is one.  The run after the late review finds nothing new.
    """
    src = scratch_path(b.spark, "incoming")
    ds = ReviewDataset(b.spark, scratch_path(b.spark, "published"))
    ckpt = scratch_path(b.spark, "stream-ckpt")
    day = F.col("review_date")
    rows = b.selection_rows.withColumn("raw_isin", G.patchy_isin_text(F.col("isin"), F.col("internal_key").cast(
        "bigint"), day))
    first, second, late = (F.lit(d).cast("date") for d in (*WAVES, LATE_REVIEW))
    entities = staged(_entities(b), "entities")
    for wave in (day < first, (day >= first) & (day < second), (day >= second) & (day != late), day == late, None):
        if wave is not None:
            write_dialects(rows.where(wave), src, packed=True)
        start_list_stream(b.spark, src, ds, ckpt, b.rules, entities)
    return ds.pinned()


@query
def incremental_sync(b: ReviewBook) -> DataFrame:
    """Membership published by the incremental runs; equals the batch chain over the resolved lists."""
    return _synced(b).table("membership").select(*KEY, "isin", "is_member", "entry_reason")


@query
def incremental_intervals(b: ReviewBook) -> DataFrame:
    """Intervals kept up to date by the incremental runs, with metadata and entity ids."""
    return _synced(b).asset_intervals()


@query
def incremental_ranking(b: ReviewBook) -> DataFrame:
    """The ranking on review dates from the ranks that the incremental runs published."""
    ds = _synced(b)
    return ds.ranking_on(ds.table("reviews").withColumnRenamed("review_date", "date"), AS_OF)


@query(stage=("candidates", "membership", "reviews"))
def backfill_chain(b: ReviewBook) -> DataFrame:
    """A corrected mid-history review (its candidates in reverse order) re-chains every later one."""
    since = _middle(b.reviews)
    cands = b.candidates.select(*KEY, "isin", "position")
    # one row per corrected review: the place after its last candidate
    ends = cands.join(F.broadcast(since), KEY).groupBy(*KEY).agg((F.max("position") + 1).alias("end"))
    corrected = cands.join(F.broadcast(ends), KEY, "left").withColumn(
        "position", F.coalesce(F.col("end") - F.col("position"), F.col("position"))).drop("end")
    return M.rechain_from(corrected, b.membership, since, b.rules, b.reviews)


@query
def member_dates(b: ReviewBook) -> DataFrame:
    """Per ISIN the sorted review dates at which it was a member (<= #reviews each)."""
    members = b.membership.where("is_member").select("index_name", "isin", "review_date").distinct()
    return members.groupBy("index_name", "isin").agg(F.array_sort(F.collect_list("review_date")).alias("member_dates"))


@query(stage=("entries",))
def prior_members(b: ReviewBook) -> DataFrame:
    """Members of the review before the latest one, read from the published dataset.

    The prior dates come from the tiny reviews table; the semi join on the
    partition columns lets dynamic partition pruning skip all other reviews.
    """
    ds = b.dataset
    w = Window.partitionBy("index_name").orderBy(F.col("review_date").desc())
    prior = ds.table("reviews").select(*KEY, F.row_number().over(w).alias("_k")).where("_k = 2").drop("_k")
    members = ds.table("membership").where("is_member")
    return members.join(F.broadcast(prior), KEY, "left_semi").select("index_name", "isin")


@query(stage=("entries",))
def published_islands(b: ReviewBook) -> DataFrame:
    """S9/W5 (Q8): intervals rebuilt from the published dataset, not from local state.

    The reviews table keeps member-less reviews, so they still break runs.
    """
    ds = b.dataset
    return membership_intervals_of(ds.table("membership"), ds.table("reviews"))


@query(stage=("entries",))
def published_ranking_at(b: ReviewBook) -> DataFrame:
    """Derived tables rebuilt from the published dataset: ranks on review dates."""
    ds = b.dataset
    entries, membership = ds.table("entries"), ds.table("membership")
    days = ds.table("reviews").withColumnRenamed("review_date", "date")
    return R.ranking_on(entries, membership, days, AS_OF)
