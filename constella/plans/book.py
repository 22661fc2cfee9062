"""The derived review dataset of one input folder, built lazily once per session.

Every registered query starts from these frames; Spark re-plans each query
end to end (no data is collected to the driver).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.operators import membership as M
from constella.operators.intervals import membership_intervals
from constella.schemas import IndexRule
from constella.session import scratch_path, staged
from constella.sources.dataset import ReviewDataset
from constella.functions.calendar import DERIVED_CALENDAR
from constella.sources import selection as S
from constella.sources.derive import (
    RULES,
    listed_reviews,
    listing,
    rank_order,
    review_assets,
    review_entries,
    selection_rows,
)

# End of the daily ranking range (the reviewed pipeline uses "today"; a fixed
# date keeps results reproducible).  After the last review of every index.
AS_OF = "2001-12-31"


class ReviewBook:
    """Shared frames of one query.

    ``stage`` names the frames that feed several branches of the query: they are
    written once as Parquet to the shared checkpoint folder and read back,
    which cuts lineage (executor loss reruns nothing upstream) and gives AQE
    real file sizes for its join choices.  ``entries`` (the numbered lists)
    are staged by their numbering; a query that names them takes its
    candidates from there, any other takes them straight from the unnumbered
    listing.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        rules: dict[str, IndexRule] | None = None,
        stage: tuple[str, ...] = (),
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.rules = rules or RULES
        self.staged_frames = stage

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return staged(df, name) if name in self.staged_frames else df

    @cached_property
    def listing(self) -> DataFrame:
        """The lists' rows without their places."""
        return self.stage(listing(self.spark, self.sf_dir), "listing")

    @cached_property
    def entries(self) -> DataFrame:
        """The lists with every row numbered."""
        return review_entries(self.spark, self.sf_dir)

    @cached_property
    def assets(self) -> DataFrame:
        return review_assets(self.spark, self.sf_dir)

    @cached_property
    def reviews(self) -> DataFrame:
        """All reviews of each index (one row per index and quarter), from the dates alone."""
        return self.stage(listed_reviews(self.spark, self.sf_dir), "reviews")

    @cached_property
    def candidates(self) -> DataFrame:
        """Positions 1..buffer_end of every review as list rows (rank = position).

        The derived lists come out of an aggregate keyed by (review, instrument), so ISINs are unique per
        review and the keep-first step (a full shuffle) is skipped; lists read from files go through it.
        """
        if "entries" in self.staged_frames:
            found = M.candidates(self.entries, self.rules, dedupe=False)
        else:
            found = M.listed_candidates(self.listing.where("eligible"), self.rules, rank_order())
            found = found.select("index_name", "review_date", "isin", "ric", "ff_mcap", "position",
                                 F.col("position").alias("rank"), F.col("position").cast("long").alias("ordinal"))
        return self.stage(found, "candidates")

    @cached_property
    def membership(self) -> DataFrame:
        return self.stage(M.chain_membership(self.candidates, self.rules), "membership")

    @cached_property
    def intervals(self) -> DataFrame:
        return membership_intervals(self.membership, self.reviews)

    @cached_property
    def latest(self) -> DataFrame:
        """O1: latest review of each index."""
        return self.reviews.groupBy("index_name").agg(F.max("review_date").alias("review_date"))

    @cached_property
    def dataset(self) -> ReviewDataset:
        """The review dataset published once to the shared folder, at that version."""
        ds = ReviewDataset(self.spark, scratch_path(self.spark, "reviews"))
        return ds.write(self.assets, self.entries, self.membership, self.reviews)

    @cached_property
    def selection_rows(self) -> DataFrame:
        """Vendor-style list rows (entry + instrument data, raw ISIN text)."""
        return selection_rows(self.entries, self.assets)

    @cached_property
    def csv_dir(self) -> str:
        """All lists, written as one CSV file per review."""
        path = scratch_path(self.spark, "csv-lists")
        S.write_csv_lists(self.selection_rows, path, packed=True)
        return path

    @cached_property
    def legacy_dir(self) -> str:
        """All lists, written as extracted report tables plus header lines."""
        path = scratch_path(self.spark, "legacy-reports")
        S.write_legacy_reports(self.selection_rows, path, packed=True)
        return path

    @cached_property
    def lists_dir(self) -> str:
        """One folder with the older lists as reports and the lists from the CSV cutoff on as CSV files."""
        path = scratch_path(self.spark, "lists")
        write_dialects(self.selection_rows, path, packed=True)
        return path


def write_dialects(rows: DataFrame, path: str, packed: bool = False) -> None:
    """Lists of both dialects in one folder, told apart by the cutoff date."""
    cut = F.lit(DERIVED_CALENDAR.csv_cutoff).cast("date")
    S.write_csv_lists(rows.where(F.col("review_date") >= cut), path, packed=packed)
    S.write_legacy_reports(rows.where(F.col("review_date") < cut), path, packed=packed)
