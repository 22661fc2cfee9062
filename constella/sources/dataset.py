"""The published review dataset: Hive-partitioned Parquet, many indexes in one table, published in one step.

Layout under ``root``::

    <table>/commit=<c>/index_name=X[/review_date=YYYY-MM-DD]/part-*.parquet
    manifest/version=<n>/part-*.parquet

A commit writes the partitions it changes into new folders and then one manifest: a row for each live
partition of each table, naming the commit that holds it.  Spark marks the manifest complete as the
last step, so a reader sees all of a commit's tables or none; a reader keeps the version it resolved
first.  Partitions that a commit does not change keep their files.  A commit that fails leaves folders
that no manifest names.

Tables: ``assets`` and ``reviews`` (every review, even member-less) by index; ``entries``, ``membership``,
``ranks`` (member ranks of a review), ``intervals`` (by the last review of the interval) and ``rejects``
by index and review.  The manifest is calendar-sized, so reads join it by broadcast on the partition
columns and Spark prunes directories before opening any file.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.functions.ranking import calendar_sized
from constella.operators.intervals import assets_with_intervals, first_per_key
from constella.operators.ranking import expand_daily, expand_on, review_spans

KEY = ["index_name", "review_date"]
BY_INDEX = ("assets", "reviews")
#: Columns of a table that nothing was published to yet.
EMPTY = {
    "assets": "isin string, internal_key string, ric string, name string, country string, currency string, "
              "sedol string, entity_id string, first_listed date, file string, ordinal long, index_name string",
    "reviews": "review_date date, index_name string",
    "entries": "isin string, ff_mcap double, rank int, comment string, ordinal long, file string, ric string, "
               "index_name string, review_date date",
    "membership": "isin string, is_member boolean, entry_reason string, index_name string, review_date date",
    "ranks": "ric string, rank int, index_name string, review_date date",
    "intervals": "isin string, first_included date, index_name string, review_date date",
    "rejects": "file string, ordinal long, reason string, value string, index_name string, review_date date",
}
_MANIFEST = "`table` string, index_name string, review_date date, `commit` string"
#: Tables of a commit that are written at the same time.
JOBS_AT_ONCE = 2
#: Manifest rows that name the last batch of a stream instead of a partition.
STREAM = "_stream"


class CommitConflict(RuntimeError):
    """Another commit was published since this one read its version."""


def keys_of(table: str) -> list[str]:
    return ["index_name"] if table in BY_INDEX else KEY


def _writer(df: DataFrame, partition_cols: list[str]):
    """Write zstd parquet by partition, spread by Spark's rebalance.

    ``REBALANCE`` brings the rows of one output partition together and lets AQE
    split what exceeds the advisory size at run time: a review that holds a
    third of all rows is written by as many tasks as it needs, small ones share
    a task.
    """
    return df.hint("rebalance", *partition_cols).write.option("compression", "zstd").partitionBy(*partition_cols)


def entries_with_ric(entries: DataFrame, assets: DataFrame) -> DataFrame:
    """Entries left-join the first RIC per ISIN of the assets."""
    rics = first_per_key(assets.select("index_name", "isin", "ric"), ["index_name", "isin"], ["ric"], ["ric"])
    return entries.drop("ric").join(rics, ["index_name", "isin"], "left")


@dataclass(frozen=True)
class Change:
    """New rows of a table.  They replace the partitions that they touch, those named by ``touched``
    (index_name, review_date) even if no row is left for them, and with ``since`` (index_name,
    review_date) all partitions of those indexes from that review on."""

    rows: DataFrame
    since: DataFrame | None = None
    touched: DataFrame | None = None


@dataclass(frozen=True)
class ReviewDataset:
    """A dataset at its latest version, or at a fixed one (``pinned``)."""

    spark: SparkSession
    root: str
    version: int | None = None

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    # --------------------------------------------------------------- versions
    def latest_version(self) -> int:
        """The number of the last complete manifest; 0 if nothing was published."""
        fs, folder = self._folder("manifest")
        if not fs.exists(folder):
            return 0
        found = [re.fullmatch(r"version=(\d+)", s.getPath().getName()) for s in fs.listStatus(folder)]
        numbers = sorted((int(m[1]) for m in found if m), reverse=True)
        return next((n for n in numbers if fs.exists(self._folder(f"manifest/version={n}/_SUCCESS")[1])), 0)

    def _folder(self, name: str):
        """The file system of a path below the root, and the path."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def pinned(self) -> ReviewDataset:
        """The dataset at the version that is the latest now."""
        return self if self.version is not None else replace(self, version=self.latest_version())

    def manifest(self) -> DataFrame:
        """Live partitions: (table, index_name, review_date, commit)."""
        version = self.pinned().version
        if not version:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path('manifest')}/version={version}")

    # ---------------------------------------------------------------- writing
    def _publish(self, name: str, table: str, change: Change) -> list[tuple]:
        """Write a table's new partitions; their manifest rows (one for each touched index or review)."""
        keys, target = keys_of(table), f"{self.path(table)}/commit={name}"
        _writer(change.rows, keys).parquet(target)
        written = self.spark.read.schema(change.rows.schema).parquet(target).select(*keys).distinct().collect()
        return [(table, r["index_name"], r["review_date"] if "review_date" in keys else None, name) for r in written]

    def commit(self, changes: dict[str, Change], batch: tuple[str, int] | None = None) -> ReviewDataset:
        """Publish all changes in one step; the dataset at the new version.

        The tables are independent, so some of their jobs run side by side (each costs the driver memory).
        ``batch`` (stream, number) is recorded, so that a replayed batch can be told (``last_batch``).
        """
        base = self.pinned()
        name = f"c{base.version + 1:06d}-{uuid.uuid4().hex[:8]}"
        with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
            parts = list(pool.map(lambda item: self._publish(name, *item), changes.items()))
        rows = [row for part in parts for row in part]
        if batch:
            rows.append((STREAM, batch[0], None, str(batch[1])))
        written = self.spark.createDataFrame(rows, _MANIFEST)
        day = F.col("review_date")
        gone = written.select("table", F.col("index_name").alias("_index"), day.alias("_from"), day.alias("_to"))
        for table, change in changes.items():
            here = F.lit(table).alias("table")
            if change.touched is not None:
                gone = gone.union(change.touched.select(here, "index_name", day, day))
            if change.since is not None:
                gone = gone.union(change.since.select(here, "index_name", day, F.lit("9999-12-31").cast("date")))
        old, gone = base.manifest(), F.broadcast(gone.withColumnRenamed("table", "_table"))
        live = old.join(gone, (F.col("table") == F.col("_table")) & (F.col("index_name") == F.col("_index")) & (
            day.isNull() | day.between(F.col("_from"), F.col("_to"))), "left_anti")
        if self.latest_version() != base.version:
            raise CommitConflict(f"version {base.version + 1} of {self.root} was published meanwhile")
        # without the mark of a finished job this folder is no version yet; a failed try is overwritten
        live.unionByName(written).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path('manifest')}/version={base.version + 1}")
        return replace(self, version=base.version + 1)

    def last_batch(self, stream: str) -> int | None:
        """The last recorded batch of a stream."""
        rows = self.manifest().where((F.col("table") == STREAM) & (F.col("index_name") == stream)).collect()
        return int(rows[0]["commit"]) if rows else None

    def write(
        self,
        assets: DataFrame,
        entries: DataFrame,
        membership: DataFrame,
        reviews: DataFrame | None = None,
    ) -> ReviewDataset:
        """Assets snapshot + entries (with RIC) + membership, by (index, review)."""
        revs = reviews if reviews is not None else entries.select(*KEY).distinct()
        known = self.pinned().table("reviews")
        return self.commit({
            "assets": Change(assets),
            "entries": Change(entries_with_ric(entries, assets)),
            "membership": Change(membership),
            "reviews": Change(revs.select(*KEY).unionByName(known.select(*KEY)).distinct()),
        })

    # ---------------------------------------------------------------- reading
    def table(self, name: str, only: DataFrame | None = None) -> DataFrame:
        """The live partitions of a table, with ``only`` those of some (index_name, review_date)."""
        keys = keys_of(name)
        live = self.manifest().where(F.col("table") == name).select("commit", *keys)
        if only is not None:
            live = live.join(calendar_sized(only), KEY, "left_semi")
        fs, folder = self._folder(name)
        if not fs.exists(folder):
            return self.spark.createDataFrame([], EMPTY[name])
        try:
            rows = self.spark.read.option("basePath", self.path(name)).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # commits without a row
                raise
            return self.spark.createDataFrame([], EMPTY[name])
        rows = rows.withColumn("index_name", F.col("index_name").cast("string"))
        return rows.join(calendar_sized(live), ["commit", *keys], "left_semi").drop("commit")

    def partitions(self, name: str) -> DataFrame:
        """(index, review) of a table's live partitions, from the manifest alone."""
        return self.manifest().where(F.col("table") == name).select(*KEY)

    def assets(self) -> DataFrame:
        return self.table("assets")

    def intervals(self) -> DataFrame:
        """Published membership intervals (index_name, isin, first_included, last_included)."""
        return self.table("intervals").select("index_name", "isin", "first_included", F.col("review_date").alias(
            "last_included"))

    def asset_intervals(self) -> DataFrame:
        """One row per interval with the instrument's metadata and entity id."""
        at = self.pinned()
        assets = at.assets()
        return assets_with_intervals(at.intervals(), assets.drop(*[
            c for c in ("first_listed", "file", "ordinal") if c in assets.columns]))

    def ranking_daily(self, as_of: dt.date | str) -> DataFrame:
        """W7 from the published ranks: they hold until the day before the next review with members."""
        at = self.pinned()
        return expand_daily(at.table("ranks"), review_spans(at.partitions("membership"), as_of))

    def ranking_on(self, days: DataFrame, as_of: dt.date | str) -> DataFrame:
        """P10 from the published ranks: the daily ranking on the given days (index_name, date)."""
        at = self.pinned()
        return expand_on(at.table("ranks"), review_spans(at.partitions("membership"), as_of), days)

    def indexes(self) -> list[str]:
        """Index names present in the dataset (one small row per index)."""
        return sorted(r.index_name for r in self.latest_reviews().collect())

    def latest(self, index_name: str) -> dt.date:
        """O1: latest review date of an index; error when there is none."""
        rows = self.latest_reviews().where(F.col("index_name") == index_name).collect()
        if not rows:
            raise ValueError(f"index '{index_name}' has no published review")
        return rows[0].review_date

    def latest_reviews(self) -> DataFrame:
        """O1 as a table: latest published review per index, from the reviews table."""
        return self.table("reviews").groupBy("index_name").agg(F.max("review_date").alias("review_date"))

    def _at(self, table: str, at: dict[str, dt.date] | None) -> DataFrame:
        ds = self.pinned()
        if at is None:
            # the live partitions are cut to these reviews first, so Spark prunes the others at run time
            return ds.table(table, ds.latest_reviews())
        df = ds.table(table)
        cond: Column | None = None
        for name, day in sorted(at.items()):
            c = (F.col("index_name") == F.lit(name)) & (F.col("review_date") == F.lit(day))
            cond = c if cond is None else cond | c
        return df.where(cond if cond is not None else F.lit(False))

    def entries_at(self, at: dict[str, dt.date] | None = None) -> DataFrame:
        """Entries of one review per index (latest by default), partition-pruned."""
        return self._at("entries", at)

    def membership_at(self, at: dict[str, dt.date] | None = None) -> DataFrame:
        """Membership of one review per index (latest by default)."""
        return self._at("membership", at)

    def constituents(self, at: dict[str, dt.date] | None = None) -> DataFrame:
        """Members joined with one asset row per ISIN (Q11: no interval duplicates)."""
        ds = self.pinned()
        members = ds.membership_at(at).where(F.col("is_member"))
        assets = ds.assets()
        keep = [c for c in ("ric", "name", "country", "currency") if c in assets.columns]
        one = first_per_key(assets.select("index_name", "isin", *keep), ["index_name", "isin"], keep, keep)
        return members.join(one, ["index_name", "isin"], "inner")

    def prior_members(self, index_name: str, before: dt.date) -> DataFrame:
        """Members of the latest review before ``before``; empty when none."""
        ds = self.pinned()
        last = (
            ds.table("reviews")
            .where((F.col("index_name") == index_name) & (F.col("review_date") < F.lit(before)))
            .agg(F.max("review_date").alias("d"))
            .first()
        )
        if last is None or last.d is None:
            return self.spark.createDataFrame([], "index_name string, isin string")
        return ds.membership_at({index_name: last.d}).where("is_member").select("index_name", "isin")


def catalog(ds: ReviewDataset) -> DataFrame:
    """One row per index: number of reviews, first and latest review date."""
    return ds.table("reviews").groupBy("index_name").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.min("review_date").alias("first_review"),
        F.max("review_date").alias("latest_review"),
    )


def require_index(ds: ReviewDataset, name: str) -> str:
    """The name, if the dataset has such an index; the error names those it has."""
    names = ds.indexes()
    if name not in names:
        raise KeyError(f"no index '{name}' here, only: {', '.join(names) or 'none'}")
    return name
