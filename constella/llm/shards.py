"""Operator 9 (native): sharding by a two-pass external shuffle.

A row's shard follows from its doc_id and the shard count alone (rendezvous hashing: the shard whose
seeded hash with the id is highest), so one shard more takes rows only into itself.

Pass 1 scatters the rows of each shard uniformly over buckets by a seeded hash of the row number;
a shard gets as many buckets as its bytes need at ``bucket_bytes`` each, so a shard that one id fills
only gets more buckets. Pass 2 takes a bucket as one array, puts it in the order of the hashes,
permutes it by Spark's ``shuffle`` (a Fisher-Yates shuffle with a seed) and writes the rows out. A
row's slot is its bucket's offset in the shard (a running sum of bucket counts) plus its place. There
is one offset for each ``bucket_bytes`` of text; up to ``BROADCAST_BUCKETS`` of them (20 MB) are
broadcast, so the rows move once, beyond that they are joined.

Only DataFrame functions are used. Row cases: a null text has no bytes (size 1, CRC 0); null ids all
go to one shard; repeated rows take a slot each; an empty table gives an empty result; extra columns
of any name travel in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from constella.llm.common import staged, table

SHARDS = 16
SEED = 9
BUCKET_BYTES = 16 << 20
BROADCAST_BUCKETS = 1_000_000


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the highest seeded hash; the lower one on a tie."""
    tries = [F.struct(F.xxhash64(doc_id, F.lit(k), F.lit(seed)).alias("h"), F.lit(-k).alias("k"))
             for k in range(shards)]
    return -F.array_max(F.array(*tries))["k"]


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
          path: str | None = None) -> DataFrame:
    """Rows ``row`` (the whole input row), ``shard``, ``slot``; with ``path`` also written there by shard."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    text, doc_id = F.col("row.text").cast("string"), F.col("row.doc_id").cast("long")
    rows = documents.select(row).select(
        "row", shard_of(doc_id, shards, seed).alias("shard"), size_of(text).alias("size"),
        F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("h"))
    sizes = {r["shard"]: r["bytes"] for r in rows.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    of_shard = [max(1, -(-sizes.get(k, 0) // bucket_bytes)) for k in range(shards)]
    buckets = F.array(*[F.lit(n) for n in of_shard])
    # pass 1: the exchange scatters, each group is one bucket
    scattered = rows.withColumn("bucket", F.pmod("h", F.element_at(buckets, F.col("shard") + 1))).groupBy(
        "shard", "bucket").agg(F.collect_list(F.struct("h", "row")).alias("rows"))
    # pass 2: order of the hashes, then Fisher-Yates over the places
    places = F.shuffle(F.array_sort(F.transform("rows", lambda x, i: F.struct(x["h"].alias("h"), i.alias("i")))), seed)
    permuted = staged(scattered.select("shard", "bucket", "rows", places.alias("places")).select(
        "shard", "bucket", F.posexplode(F.transform("places", lambda p: F.get("rows", p["i"])["row"])).alias(
            "place", "row")), "shards")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = permuted.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    if sum(of_shard) <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    out = permuted.join(offsets, ["shard", "bucket"]).select(
        "row", F.col("shard").cast("int").alias("shard"), (F.col("offset") + F.col("place")).alias("slot"))
    if path:
        out.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.mode(
            "overwrite").partitionBy("shard").parquet(path)
    return out


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    text = F.col("row.text").cast("string")
    doc_id = F.col("row.doc_id").cast("long")
    return out.select(
        doc_id.alias("doc_id"), size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), shard_of(doc_id, SHARDS + 1).cast("int").alias("grown_shard"))
