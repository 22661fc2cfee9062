"""Operator 12: dimension-sharded Lloyd clustering.

Vectors are cut into tiles: a chunk of rows times a block of columns. A round has three steps.

1. Column-block tasks: each tile computes the exact squared distances of its columns to the centroids'
   slices of the same columns (rows x centroids).
2. Reduce by chunk: the partial distances of a chunk's blocks are added, and the least sum names each
   row's cluster (the smaller number on a tie).
3. Each shard updates its own slice: a tile sums its columns by cluster, the sums of a column block are
   added over all chunks, and the new slice is their floored mean; an empty cluster keeps its slice.

All arithmetic is on integers. What moves per round: partial distances (centroids x blocks numbers a
row), one label a row, and the tiles to their labels. Only the centroids (clusters x columns numbers)
come to the driver. Every group has a fixed size: a chunk has as many partial tables as there are blocks, and
sums are combined in each task before they meet by block, so neither a cluster nor a vector that a
third of the rows share makes a group larger.

Row cases: vectors that are null, of another length than ``dims``, or hold null or non-finite
components take no part. A null vec_id counts as the empty text in the initial order; equal ids are
ordered by their components. Repeated rows are vectors of their own. Fewer vectors than clusters make
fewer clusters; an empty table gives an empty result. Components beyond ``vectors.LARGEST`` count as that; sums
beyond 64 bits are given as the largest long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import staged, table
from constella.llm.vectors import LARGEST, exact_products, finite, integers, matrix, packed, unpacked

CLUSTERS, ROUNDS, DIMS = 40, 5, 64
BLOCK_COLUMNS = 32
CHUNK_ROWS = 4096
_TILE = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("kind", pa.string()), ("data", pa.binary()),
                   ("ids", pa.list_(pa.int64()))])
_SLICE = pa.schema([("block", pa.int32()), ("data", pa.binary())])


def kept(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """Rows (vec_id, e): the vectors that take part, as integers."""
    whole = vectors.where((F.size("embedding") == dims) & finite(F.col("embedding")))
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("e"))


def initial(vectors: DataFrame, clusters: int, seed: int = 2) -> np.ndarray:
    """The vectors whose hashed ids come first (a top-k of ``clusters`` rows)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(order, "e").limit(clusters).select("e").collect()
    return np.array([r["e"] for r in rows], np.int64)


def tiles(vectors: DataFrame, dims: int, block_columns: int, chunk_rows: int) -> DataFrame:
    """Staged tiles of ``chunk_rows`` rows and ``block_columns`` columns; block -1 holds the ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(at, chunk_rows)
                e = matrix(part.column(1), dims)
                rows = [{"chunk": chunk, "block": -1, "ids": part.column(0).to_pylist()}]
                for block, column in enumerate(range(0, dims, block_columns)):
                    kind, data = packed(e[:, column:column + block_columns])
                    rows.append({"chunk": chunk, "block": block, "kind": kind, "data": data})
                chunk += 1
                yield pa.RecordBatch.from_pylist(rows, _TILE)

    return staged(vectors.select("vec_id", "e").mapInArrow(
        cut, "chunk long, block int, kind string, data binary, ids array<long>"), "tiles")


def partial_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroid slices."""
    return (x * x).sum(axis=1)[:, None] - 2 * exact_products(x, centroids) + (centroids * centroids).sum(axis=1)


def assign(tiled: DataFrame, centroids: np.ndarray, block_columns: int) -> DataFrame:
    """Per chunk: the clusters of its rows and their distances, as bytes."""
    k = len(centroids)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = row["block"] * block_columns
                part = centroids[:, at:at + block_columns]
                kind, data = packed(partial_distances(unpacked(row["kind"], row["data"], part.shape[1]), part))
                yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], "kind": kind, "data": data}])

    def nearest(parts: pa.Table) -> pa.Table:
        total = sum(unpacked(r["kind"], r["data"], k) for r in parts.to_pylist())
        label = total.argmin(axis=1)
        return pa.Table.from_pylist([{
            "chunk": parts["chunk"][0].as_py(), "labels": label.astype(np.int32).tobytes(),
            "distances": total[np.arange(len(total)), label].tobytes()}])

    partial = tiled.where("block >= 0").select("chunk", "block", "kind", "data").mapInArrow(
        measure, "chunk long, kind string, data binary")
    return partial.groupBy("chunk").applyInArrow(nearest, "chunk long, labels binary, distances binary")


def update(tiled: DataFrame, labels: DataFrame, centroids: np.ndarray, block_columns: int) -> np.ndarray:
    """New centroids: each column block's slice is the floored mean of its columns by cluster."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                width = min(block_columns, centroids.shape[1] - row["block"] * block_columns)
                x = unpacked(row["kind"], row["data"], width)
                label = np.frombuffer(row["labels"], np.int32)
                order = np.argsort(label, kind="stable")
                found, first = np.unique(label[order], return_index=True)
                held = sums.setdefault(row["block"], np.zeros((k, width + 1), np.int64))
                held[found, :width] += np.add.reduceat(x[order], first, axis=0)
                held[:, width] += np.bincount(label, minlength=k)
        yield pa.RecordBatch.from_pylist([{"block": b, "data": s.tobytes()} for b, s in sums.items()], _SLICE)

    def mean(parts: pa.Table) -> pa.Table:
        block = parts["block"][0].as_py()
        old = centroids[:, block * block_columns:(block + 1) * block_columns]
        total = sum(np.frombuffer(d, np.int64).reshape(k, -1).astype(object) for d in parts["data"].to_pylist())
        new = [[s // row[-1] for s in row[:-1]] if row[-1] else was for row, was in zip(total, old.tolist(),
                                                                                       strict=True)]
        return pa.Table.from_pylist([{"block": block, "data": np.array(new, np.int64).tobytes()}], _SLICE)

    joined = tiled.where("block >= 0").select("chunk", "block", "kind", "data").join(
        labels.select("chunk", "labels"), "chunk")
    slices = joined.select("block", "kind", "data", "labels").mapInArrow(add, "block int, data binary").groupBy(
        "block").applyInArrow(mean, "block int, data binary").collect()
    return np.concatenate([np.frombuffer(r["data"], np.int64).reshape(k, -1)
                           for r in sorted(slices, key=lambda r: r["block"])], axis=1)


def lloyd(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
          block_columns: int = BLOCK_COLUMNS, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, cluster, distance) of rows (vec_id, e), and the final centroids."""
    schema = "vec_id long, cluster int, distance long"
    tiled = tiles(vectors, dims, block_columns, chunk_rows)
    centroids = initial(vectors, clusters)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    for _ in range(rounds):
        centroids = update(tiled, assign(tiled, centroids, block_columns), centroids, block_columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[k].values, pa.array(np.frombuffer(batch.column(1)[k].as_py(), np.int32)),
                     pa.array(np.frombuffer(batch.column(2)[k].as_py(), np.int64))],
                    names=["vec_id", "cluster", "distance"])

    named = tiled.where("block = -1").select("chunk", "ids").join(assign(tiled, centroids, block_columns), "chunk")
    return staged(named.select("ids", "labels", "distances").mapInArrow(rows, schema), "clusters"), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = lloyd(kept(table(spark, sf_dir, "embeddings")))
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row for each cluster
    most = (1 << 63) - 1
    total = min(sum(sums.values()), most)
    known = [(k, min(sums.get(k, 0), most), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for k, c in enumerate(centroids.tolist())]
    of_cluster = spark.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql_rounds() -> str:
    out = []
    for r in range(ROUNDS + 1):
        out.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, e, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.vec_id, v.e, k.c, list_sum(list_transform(list_zip(v.e, k.e),
      lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} k) GROUP BY vec_id, e)""")
        if r < ROUNDS:
            out.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT k.c, coalesce(m.e, k.e) AS e FROM c{r} k LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM (
      SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n
      FROM (SELECT c, unnest(e) AS x, unnest(range(len(e))) AS i FROM a{r}) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return ",".join(out)


OP12_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: greatest(least(floor(x::DOUBLE * 256), {LARGEST}), -{LARGEST})::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = {DIMS}
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS c, e FROM v
  ORDER BY c LIMIT {CLUSTERS}),
{_sql_rounds().lstrip()}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} k USING (c)
"""
