"""Clustering and top-k search over vectors, against brute force on small tables."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from constella.llm import centroids, topk
from constella.llm.vectors import LARGEST, exact_products, finite, integers, packed, unpacked

SCHEMA = "vec_id long, embedding array<float>, label int, chunk long, at long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2)
                                  for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [max(-LARGEST, min(LARGEST, math.floor(float(np.float32(x)) * 256))) for x in v]


def table(n, dims, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2 + i % 5) for _ in range(dims)]) for i in range(n)]
    rows += [(3, rows[3][1]), (None, rows[5][1]), (50, [0.25] * dims), (50, [0.25] * dims), (100, [0.0] * dims)]
    rows += [(60 + i, [0.25] * dims) for i in range(20)]  # one vector that many rows hold
    return rows


BROKEN = [(700, None), (701, []), (702, [1.0, None, 2.0]), (703, [float("nan")] * 3), (704, [float("inf"), 1.0, 1.0]),
          (705, [1.0, 2.0])]


def brute_lloyd(rows, clusters, rounds, dims):
    held = [(i, whole(v)) for i, v in rows if usable(v) and len(v) == dims]
    order = sorted(held, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(now))

    for _ in range(rounds):
        groups = {}
        for _, v in held:
            groups.setdefault(nearest(v)[1], []).append(v)
        now = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else c
               for k, c in enumerate(now)]
    return sorted(((i, *reversed(nearest(v))) for i, v in held), key=str), now


@pytest.mark.parametrize(("block_columns", "chunk_rows"), [(2, 7), (3, 4096), (5, 40)])
def test_lloyd_equals_brute_force(spark, block_columns, chunk_rows):
    rows = table(90, 5, 1) + BROKEN
    found, final = centroids.lloyd(centroids.kept(frame(spark, rows).repartition(3), 5), 12, 4, 5, block_columns,
                                   chunk_rows)
    expected, means = brute_lloyd(rows, 12, 4, 5)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str) == expected
    assert final.tolist() == means


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0])]
    found, final = centroids.lloyd(centroids.kept(frame(spark, rows), 2), 40, 5, 2)
    assert len(final) == 2 and sorted((r.vec_id, r.cluster, r.distance) for r in found.collect()) == [
        (1, 0, 0), (2, 0, 0)]
    found, final = centroids.lloyd(centroids.kept(frame(spark, BROKEN), 64))
    assert found.count() == 0 and len(final) == 0


def test_huge_components_do_not_overflow(spark):
    rows = [(1, [3e38, -3e38]), (2, [-3e38, 3e38]), (3, [0.0, 0.0])]
    found, _ = centroids.lloyd(centroids.kept(frame(spark, rows), 2), 1, 0, 2)
    assert max(r.distance for r in found.collect()) <= 2 * (2 * LARGEST) ** 2
    vectors = frame(spark, [(0, [3e38, 3e38]), (1, [3e38, 3e38])]).select("vec_id", integers(F.col("embedding")).alias("e"))
    assert [r.score for r in topk.top_products(vectors).collect()] == [2 * LARGEST ** 2]


def brute_top(rows, k, every):
    held = [(i, whole(v)) for i, v in rows if usable(v)]
    out = []
    for a, (i, q) in enumerate(held):
        if i is not None and i % every == 0:
            scored = [(-sum(x * y for x, y in zip(q, v, strict=False)), j is None, j or 0, j)
                      for b, (j, v) in enumerate(held) if b != a]
            out += [(i, n, s[3], -s[0]) for n, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("slab_rows", [3, 32, 16384])
@pytest.mark.parametrize("head_rows", [2, 16])
def test_top_products_equal_brute_force(spark, slab_rows, head_rows):
    rows = table(230, 17, 4) + BROKEN + [(800, [9.0] * 9), (-50, [1.0] * 17)]
    df = frame(spark, rows).repartition(3)
    vectors = df.where(finite(F.col("embedding"))).select("vec_id", integers(F.col("embedding")).alias("e"))
    got = topk.top_products(vectors, 5, 10, slab_rows, head_rows)
    assert sorted(map(tuple, got.collect()), key=str) == brute_top(rows, 5, 10)


def test_top_products_of_few_or_no_vectors(spark):
    for rows in ([], [(0, [])], [(0, []), (50, []), (1, [])], [(0, [1.0])], [(0, [1.0]), (1, [2.0]), (2, [2.0])]):
        vectors = frame(spark, rows).where(finite(F.col("embedding"))).select(
            "vec_id", integers(F.col("embedding")).alias("e"))
        assert sorted(map(tuple, topk.top_products(vectors).collect()), key=str) == brute_top(rows, 5, 50)


def test_pruning_drops_pairs_and_no_result():
    rng = np.random.default_rng(6)
    x = np.floor(rng.standard_normal((4000, 24)) * np.geomspace(200, 1, 24)).astype(np.int64)
    x = x[np.argsort(-topk.lengths(x), kind="stable")]
    q = x[::400]
    seen = []
    plain = topk.exact_products
    turned = np.linalg.svd((x.T @ x).astype(float))[2].T
    best = topk.Best(len(q), 5, np.full(len(q), topk.NONE))
    try:
        topk.exact_products = lambda a, b: seen.append(len(a) * len(b)) or plain(a, b)
        topk.search(q, np.arange(len(q)) - 100, x, np.arange(len(x)), list(range(len(x))), turned, best)
    finally:
        topk.exact_products = plain
    scores = q @ x.T
    for k in range(len(q)):
        assert best.held[k] == sorted((-int(s), False, i) for i, s in enumerate(scores[k]))[:5]
    assert sum(seen) < scores.size / 2


def test_packing_and_exact_products():
    for top in (0, 127, 128, 40_000, 1 << 31, 1 << 40):
        x = np.array([[top, -top], [1, -1]], np.int64)
        assert (unpacked(*packed(x), 2) == x).all()
    big = np.array([[LARGEST, LARGEST - 1]], np.int64)
    assert exact_products(big, big)[0, 0] == LARGEST ** 2 + (LARGEST - 1) ** 2
