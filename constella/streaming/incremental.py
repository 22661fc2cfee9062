"""Incremental ingestion of selection-list files (Structured Streaming).

``start_list_stream`` watches a folder of lists of both dialects.  With the ``availableNow`` trigger
each run processes exactly the files that arrived since the last run (the checkpoint records them) and
stops; a second run with no new files does nothing.  Every micro-batch:

1. pins the dataset's version and builds the key -> ISIN lookup from the assets published there;
2. parses its files, each in the dialect of its suffix, and refuses the batch before anything is
   written unless every list has exactly one review date;
3. per index, takes the earliest review of the batch as the start of the chain to recompute (a late,
   backfilled list re-chains everything after it) and the published member set before it as prior;
4. extends what is derived, from the changed reviews only: member ranks, membership intervals, and the
   entity ids of the assets;
5. publishes all tables in one step.  Partitions that do not change keep their files.

Entries keep the file they came from, and a batch replaces its files' rows.  The commit records the
stream's batch number, so a batch that was published but not yet checkpointed is not applied again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.functions.ranking import calendar_sized
from constella.operators import membership as M
from constella.operators.intervals import extend_intervals, merge_listed
from constella.operators.ranking import member_ranks
from constella.operators.resolve import enrich_counted, isin_lookup
from constella.schemas import IndexRule
from constella.session import staged
from constella.sources.dataset import Change, ReviewDataset
from constella.sources.selection import PACKED_GLOB, Lists, check_dates, read_lists

KEY = ["index_name", "review_date"]
# of an instrument, in the order of its first listing
PLACE = ["first_listed", "file", "ordinal"]
METADATA = ["internal_key", "ric", "name", "country", "currency", "sedol"]


def published_lookup(ds: ReviewDataset) -> DataFrame:
    """Key -> ISIN of the published assets; of several valid rows of a key the last listed one wins."""
    return isin_lookup(ds.assets().withColumn("_place", F.struct(*PLACE)), "_place")


def ingest_lists(
    lists: Lists,
    ds: ReviewDataset,
    rules: dict[str, IndexRule],
    entities: DataFrame | None = None,
    batch: tuple[str, int] | None = None,
) -> ReviewDataset:
    """Publish parsed lists and all that follows from them; the dataset at its new version."""
    # Parse once; dates, rows, rejects and every later job of the batch read this copy.
    lists = lists.once()
    # Small frames that many plans of the batch read are written once as well: each plan that derives them
    # anew costs the driver its exchanges.
    dates = staged(lists.dates, "batch-dates")
    check_dates(dates)
    base = ds.pinned()
    rows = lists.rows
    new_entries = rows.where(F.col("isin").isNotNull()).select(
        *KEY, "isin", "ric", "ff_mcap", "rank", "comment", "ordinal", F.col("_path").alias("file"))
    # every list is a review, even one without a usable row
    new_reviews = staged(dates.select(*KEY).distinct(), "batch-reviews")
    since = staged(new_reviews.groupBy("index_name").agg(F.min("review_date").alias("review_date")), "batch-since")
    reviews = staged(base.table("reviews").select(*KEY).union(new_reviews).distinct(), "batch-calendar")

    # Same-date lists that arrived earlier are kept next to the new ones; a list that comes again (a
    # corrected file) replaces its own rows.  Only the touched reviews' partitions are read.
    files = new_entries.select("index_name", "file").distinct()
    kept = base.table("entries", new_reviews).select(*new_entries.columns).join(
        files, ["index_name", "file"], "left_anti")
    # (the new rows are staged already)
    entries = new_entries.unionByName(staged(kept, "batch-kept"))
    start = F.broadcast(since.select("index_name", F.col("review_date").alias("_since")))
    later_reviews = reviews.join(start, "index_name").where(F.col("review_date") >= F.col("_since")).select(*KEY)
    untouched = staged(later_reviews.join(calendar_sized(new_reviews), KEY, "left_anti"), "batch-later")
    later = base.table("entries", untouched).select(*entries.columns)
    changed_entries = entries.unionByName(later)

    cands = M.candidates(M.leading_first(changed_entries, rules), rules, dedupe=False)
    membership = staged(M.rechained(cands, base.table("membership"), since, rules, reviews), "batch-membership")

    listed = rows.select("index_name", "isin", *METADATA, F.col("review_date").alias("first_listed"),
                         F.col("_path").alias("file"), "ordinal")
    # the first listing of an instrument counts, whatever the order of the files in the batch
    known = base.assets().join(calendar_sized(since.select("index_name")), "index_name", "left_semi")
    assets = merge_listed(known, listed.where(F.col("isin").isNotNull()), ["index_name", "isin"], PLACE)
    if entities is not None:
        assets, _ = enrich_counted(assets, entities, one_per_isin=True)
    else:
        assets = staged(assets.drop("_spread"), "batch-assets").withColumn("entity_id", F.lit(None).cast("string"))

    ranks = member_ranks(changed_entries, membership, assets).where(F.col("rank") > 0)
    intervals, place = extend_intervals(base.intervals(), membership, reviews, since)
    dated = dates.groupBy("index_name", "file").agg(F.max("review_date").alias("review_date"))
    rejects = lists.rejects.join(dated, ["index_name", "file"])
    noted = base.table("rejects", new_reviews).join(dated.select("index_name", "file"), ["index_name", "file"],
                                                    "left_anti")
    columns = [*KEY, "file", "ordinal", "reason", "value"]
    return base.commit({
        "assets": Change(assets),
        "entries": Change(entries, touched=new_reviews),
        "membership": Change(membership, since),
        "reviews": Change(reviews.join(calendar_sized(since.select("index_name")), "index_name", "left_semi")),
        "ranks": Change(ranks.select(*KEY, "ric", F.col("rank").cast("int").alias("rank")), since),
        "intervals": Change(intervals.withColumnRenamed("last_included", "review_date"), place),
        "rejects": Change(rejects.select(*columns).unionByName(noted.select(*columns)), touched=new_reviews),
    }, batch)


def start_list_stream(
    spark: SparkSession,
    source: str,
    ds: ReviewDataset,
    checkpoint: str,
    rules: dict[str, IndexRule],
    entities: DataFrame | None = None,
) -> None:
    """Process the files that arrived since the last run, then stop.

    The stream carries the files' paths (their content is not read); a batch names its files once, so
    every file is parsed as a whole.  ``entities`` (index_name, endpoint, id, alpha_id) gives the ids.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{{csv,json}}{PACKED_GLOB}")
        .load(source)
        .select("path")
    )

    def each(batch: DataFrame, epoch: int) -> None:
        paths = [r.path for r in batch.collect()]  # one short row for each new list
        base = ds.pinned()
        done = base.last_batch(stream)
        if paths and (done is None or done < epoch):
            lists = read_lists(batch.sparkSession, paths, published_lookup(base))
            ingest_lists(lists, base, rules, entities, (stream, epoch))

    q = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
