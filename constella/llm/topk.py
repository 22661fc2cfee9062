"""Operator 13: exact top-k inner products over norm-sorted vectors.

1. Vectors are sorted by length, longest first (a range sort; equal lengths by id), and packed into
   slabs of ``slab_rows`` rows. Queries (ids divisible by ``every``) are packed beside them.
2. Rotation: the right singular vectors of all vectors, from their columns-by-columns Gram matrix,
   summed over all slabs. Rotated vectors carry most of a product in their first columns.
3. Thresholds: every query meets the ``HEAD`` longest vectors (one block of bounded size); its k-th best
   score there is a score that a candidate must reach.
4. By Cauchy-Schwarz a query needs only slabs whose longest vector times its own length reaches its
   threshold. It is sent to those, so a slab meets queries in blocks of bounded size.
5. In a slab, rows go by descending length; a query stops where the length bound falls below its k-th
   best. For the others the partial sum over the first rotated columns plus the product of the
   residual lengths bounds the score; a pair below the threshold is dropped, a survivor gets its exact
   integer score. Bounds are rounded outwards, so no result depends on floating point.
6. A query's best of each slab meet in a top-k per query, partial before it moves.

The queries grow with the table, so the work does too in rows x queries at worst (all lengths equal,
no direction prevails); nothing is sampled or capped.

Row cases: null vectors and those with null or non-finite components take no part. A shorter vector is
filled with zeros; an empty one is the zero vector. A null vec_id is a candidate, after all others on
ties, and no query. Repeated rows are candidates for each other, and each is a query of its own.
An empty table gives an empty result. Components beyond ``vectors.LARGEST`` count as that. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from constella.llm.common import staged, table
from constella.llm.vectors import LARGEST, exact_products, finite, integers, matrix, packed, unpacked

K, EVERY = 5, 50
SLAB_ROWS = 16_384
HEAD = 1024
STEP_ROWS = 512
_SLAB = pa.schema([("slab", pa.int64()), ("longest", pa.float64()), ("kind", pa.string()), ("data", pa.binary()),
                   ("at", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))])
_SLAB_DDL = "slab long, longest double, kind string, data binary, at array<long>, ids array<long>"
_FOUND = "query_at long, query_id long, vec_id long, score long"
#: The threshold of a query that has met fewer than k candidates.
NONE = -(1 << 62)


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def slabs(vectors: DataFrame, width: int, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """Staged slabs of vectors by descending length; ``at`` numbers the rows."""
    length = F.aggregate("e", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.withColumn("length", length)
    order = [F.col("length").desc(), F.col("vec_id").asc_nulls_last(), F.xxhash64("e")]
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("at"), "vec_id", "e")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, slab_rows):
                part = batch.slice(k, slab_rows)
                x = matrix(part.column(2), width)
                kind, data = packed(x)
                yield pa.RecordBatch.from_pylist([{
                    "slab": part.column(0)[0].as_py(), "longest": float(lengths(x).max(initial=0.0)), "kind": kind,
                    "data": data, "at": part.column(0).to_pylist(), "ids": part.column(1).to_pylist()}], _SLAB)

    return staged(numbered.mapInArrow(pack, _SLAB_DDL), "slabs")


def rotation(packed_slabs: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors (as columns) of all vectors; a matrix of width x width numbers."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for row in batch.to_pylist():
                x = unpacked(row["kind"], row["data"], width).astype(np.float64)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["g"])

    rows = packed_slabs.select("kind", "data").mapInArrow(gram, "g array<double>").select(
        F.posexplode("g").alias("place", "g")).groupBy("place").agg(F.sum("g").alias("g")).collect()
    total = np.zeros(width * width)
    for r in rows:
        total[r["place"]] = r["g"]
    return np.linalg.svd(total.reshape(width, width))[2].T


class Best:
    """The k best candidates of each query so far: higher score first, then the smaller id."""

    def __init__(self, queries: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.held: list[list[tuple[int, bool, int]]] = [[] for _ in range(queries)]

    def offer(self, query: int, scores: np.ndarray, ids: list[int | None]) -> None:
        """``scores`` are at least ``least[query]``."""
        if len(scores) > 4 * self.k:  # the k-th best of these already rules most out
            bar = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = np.flatnonzero(scores >= bar)
            scores, ids = scores[keep], [ids[i] for i in keep.tolist()]
        rows = self.held[query] + [(-s, i is None, i or 0) for s, i in zip(scores.tolist(), ids, strict=True)]
        self.held[query] = sorted(rows)[:self.k]
        if len(self.held[query]) == self.k:
            self.least[query] = max(self.least[query], -self.held[query][-1][0])


def search(q: np.ndarray, q_at: np.ndarray, x: np.ndarray, x_at: np.ndarray, x_ids: list[int | None],
           turned: np.ndarray, best: Best) -> None:
    """Offer the candidates ``x``, by descending length, to the queries ``q``."""
    width = q.shape[1]
    cuts = sorted({max(1, width // 8), max(1, width // 4), max(1, width // 2)} - {width}) if width else []
    q_length, x_length = lengths(q), lengths(x)
    q_turned = q @ turned if width else q.astype(np.float64)
    # outward rounding of the bounds: far above the error of sums of doubles of this size
    slack = 1e-9

    def rest(turned_rows: np.ndarray, length: np.ndarray, cut: int) -> np.ndarray:
        gone = (turned_rows[:, :cut] ** 2).sum(axis=1)
        return np.sqrt(np.maximum(length ** 2 * (1 + slack) - gone, 0.0))

    q_rest = [rest(q_turned, q_length, cut) for cut in cuts]
    for at in range(0, len(x), STEP_ROWS):
        rows = slice(at, at + STEP_ROWS)
        bound = q_length * x_length[at] * (1 + slack) + slack
        live = np.flatnonzero(bound >= best.least)
        if not len(live):
            break  # all later rows are shorter
        y, y_length = x[rows], x_length[rows]
        y_turned = y @ turned if width else y.astype(np.float64)
        alive = np.ones((len(live), len(y)), bool)
        alive &= q_length[live, None] * y_length * (1 + slack) + slack >= best.least[live, None]
        partial, before = np.zeros(alive.shape), 0
        for cut, rests in zip(cuts, q_rest, strict=True):
            partial += q_turned[live, before:cut] @ y_turned[:, before:cut].T
            error = slack * q_length[live, None] * y_length + slack
            alive &= partial + rests[live, None] * rest(y_turned, y_length, cut) + error >= best.least[live, None]
            before = cut
            if not alive.any():
                break
        some_q, some_y = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(some_q):
            continue
        scores = exact_products(q[live[some_q]], y[some_y])
        good = alive[np.ix_(some_q, some_y)] & (scores >= best.least[live[some_q], None])
        good &= q_at[live[some_q], None] != x_at[rows][some_y]  # not the query's own row
        for k in np.flatnonzero(good.any(axis=1)).tolist():
            hit = np.flatnonzero(good[k])
            best.offer(int(live[some_q[k]]), scores[k, hit], [x_ids[at + int(some_y[h])] for h in hit])


def _vectors(row: dict, width: int) -> np.ndarray:
    return unpacked(row["kind"], row["data"], width) if width else np.zeros((len(row["at"]), 0), np.int64)


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY, slab_rows: int = SLAB_ROWS,
                 head_rows: int = HEAD) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of rows (vec_id, e)."""
    width = vectors.agg(F.max(F.size("e")).alias("w")).first()["w"]
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if width is None:
        return empty
    packed_slabs = slabs(vectors, width, slab_rows)
    turned = rotation(packed_slabs, width) if width else np.zeros((0, 0))
    # a number for each slab; the longest rows are the start of the first slabs
    longest = sorted((r["slab"], r["longest"]) for r in packed_slabs.select("slab", "longest").collect())
    first = packed_slabs.orderBy("slab").limit(-(-head_rows // slab_rows)).collect()
    head = np.concatenate([_vectors(r, width) for r in first])[:head_rows]
    head_at = np.concatenate([np.array(r["at"], np.int64) for r in first])[:head_rows]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries, in blocks, to each slab that they need, with their thresholds."""
        for batch in batches:
            for row in batch.to_pylist():
                pick = [i for i, v in enumerate(row["ids"]) if v is not None and v % every == 0]
                if not pick:
                    continue
                q, q_at = _vectors(row, width)[pick], np.array(row["at"], np.int64)[pick]
                ids = np.array([row["ids"][i] for i in pick], np.int64)
                scores = exact_products(q, head)
                scores[q_at[:, None] == head_at] = NONE
                least = (np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                         if scores.shape[1] >= k else np.full(len(q), NONE))
                length = lengths(q)
                for slab, top in longest:
                    need = np.flatnonzero(length * top * (1 + 1e-9) + 1e-9 >= least)
                    if not len(need):
                        break
                    kind, data = packed(q[need])
                    yield pa.RecordBatch.from_pylist([{
                        "slab": slab, "q_kind": kind, "q_data": data, "q_at": q_at[need].tolist(),
                        "q_ids": ids[need].tolist(), "least": least[need].tolist()}])

    sent = packed_slabs.select("slab", "kind", "data", "at", "ids").mapInArrow(
        send, "slab long, q_kind string, q_data binary, q_at array<long>, q_ids array<long>, least array<long>")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_ in range(batch.num_rows):
                row = batch.slice(k_, 1).to_pylist()[0]
                q = _vectors({"kind": row["q_kind"], "data": row["q_data"], "at": row["q_at"]}, width)
                best = Best(len(q), k, np.array(row["least"], np.int64))
                search(q, np.array(row["q_at"], np.int64), _vectors(row, width), np.array(row["at"], np.int64),
                       row["ids"], turned, best)
                found = [(at, i, None if none else v, -s) for at, i, held in zip(
                    row["q_at"], row["q_ids"], best.held, strict=True) for s, none, v in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[c] for f in found], pa.int64()) for c in range(4)],
                    names=["query_at", "query_id", "vec_id", "score"])

    pairs = sent.join(packed_slabs.select("slab", "kind", "data", "at", "ids"), "slab")
    found = pairs.mapInArrow(meet, _FOUND)
    order = Window.partitionBy("query_at").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors.where(finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("e")))


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: greatest(least(floor(x::DOUBLE * 256), {LARGEST}), -{LARGEST})::BIGINT) AS e,
    row_number() OVER () AS r
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
s AS (
  SELECT q.r AS q, q.vec_id AS query_id, v.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, v.e),
    lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
  FROM v q, v WHERE q.vec_id % {EVERY} = 0 AND q.r <> v.r)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
WHERE rank <= {K}
"""
