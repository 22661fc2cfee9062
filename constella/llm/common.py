"""Helpers shared by the text operators: table readers, staging, fold tests, connected classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage in the shared checkpoint folder (for narrow tables)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as compressed Parquet in the shared folder and read back (for wide tables)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of 1,000 rows unless the session asks for another number than Spark's default.

    Batches are counted in rows; at 10,000 whole texts each, a batch takes hundreds of MB off the heap. The
    setting stays for the session: plans read it when they run, which may be after the caller's return.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, "1000")
    return spark


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def hashed_sample(df: DataFrame, key: Column, rows: int, population: int) -> DataFrame:
    """About ``rows`` of the ``population`` rows of ``df``, chosen by a hash of ``key``."""
    if population <= rows:
        return df
    share = int(rows / population * (1 << 32))
    return df.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 32)) < share)


def text_batches(batches: Iterator[pa.RecordBatch], column: int, rows: int = 256) -> Iterator[tuple]:
    """(slice of the batch, its texts as a list) with at most ``rows`` rows each."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words (``xxh3_64``), as the digests' bytes: no Python number is made for a word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def min_classes(pairs: DataFrame) -> DataFrame:
    """Connected classes of undirected links ``(a, b)``: rows ``(node, label)``, label = least member.

    Large-star and small-star steps in turn (Kiveris et al., "Connected Components in MapReduce
    and Beyond"); each round is one or two aggregates, and the links are cut from their lineage in
    the shared folder. No neighbourhood is collected: each step needs a node's least neighbour only. Rounds
    go on until all is settled; each one shortens every path, so their number grows with its logarithm.
    """
    links = checkpointed(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct())
    while True:
        # large star: every larger neighbour of a node points to the node's least neighbour (itself included)
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours point to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        step = checkpointed(small)
        # done when every node points to one root, and no root points on
        open_ = step.groupBy("a").count().where("count > 1").select("a").union(
            step.select("a").join(step.select(F.col("b").alias("a")), "a", "left_semi")).limit(1)
        links = step
        if open_.isEmpty():
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
