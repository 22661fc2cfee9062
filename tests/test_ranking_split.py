"""Numbering within groups is spread evenly over tasks and equals a plain sort."""

import random
from collections import Counter

from pyspark.sql import functions as F

from constella.functions.ranking import TASK_BIT, numbered_parts, ranked_within


def table(spark, n, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randint(0, 5)}", rng.choice([7, rng.randint(0, 50)]), f"k{i:06d}")
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, v int, k string")


def test_numbering_equals_sorting(spark):
    rows, df = table(spark, 3000, 3)
    out = ranked_within(df, ["g"], [F.col("v").desc(), F.col("k")], "n")
    assert out.columns == ["g", "v", "k", "n"]
    want = []
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want += [(g, k, n) for n, (_, _, k) in enumerate(own, 1)]
    assert sorted(map(tuple, out.select("g", "k", "n").collect())) == sorted(want)


def test_no_task_numbers_a_whole_group_or_tie(spark):
    """One group of 60 % of the rows, half of them equal in the order's first column."""
    _, df = table(spark, 40_000, 5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # no merging of small parts
        parts = numbered_parts(df, ["g"], ["v", "k"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = Counter(r[0] for r in parts.select(F.shiftright("_at", TASK_BIT)).collect())
    assert len(sizes) == 16 and max(sizes.values()) <= 2 * 40_000 / 16


def test_empty(spark):
    _, df = table(spark, 1, 1)
    assert ranked_within(df.limit(0), ["g"], ["v", "k"], "n").count() == 0
