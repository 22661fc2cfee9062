"""Row numbering within groups, spread evenly over tasks whatever the groups' sizes.

A group can hold a large share of all rows (one review of a big universe), and many of its rows can be
equal in the leading order columns. So rows are dealt by Spark's range partitioner over (group, order):
its bounds follow the rows' distribution, a large group is cut into several parts, and since the order
ends with a unique key, ties are cut too. Each part is sorted and numbered by its own task; a part's
offset in its group is the running count of the group's earlier parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constella.session import staged

# monotonically_increasing_id: the task's number above this bit, the row's place in the task below
TASK_BIT = 33


def numbered_parts(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column], last: Column | None = None
) -> DataFrame:
    """``df`` in order with ``_at``, staged: increasing over (group, order), gapless inside a task.

    ``last`` is a computed last order column: worked out on either side of the shuffle, once a row, and neither
    moved nor staged.
    """
    keys = [*[F.col(c) for c in group_cols], *[F.col(c) if isinstance(c, str) else c for c in order_cols]]
    if last is None:
        placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        placed = df.repartitionByRange(*keys, last).withColumn("_last", last).sortWithinPartitions(*keys, "_last")
    return staged(placed.withColumn("_at", F.monotonically_increasing_id()).drop("_last"), "numbered")


def ranked_within(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column], out_col: str,
    last: Column | None = None,
) -> DataFrame:
    """Add ``out_col`` = 1-based row number of each row inside its group (group keys are not null).

    ``order_cols`` must be a total order inside a group (end with a unique key, or have it computed as ``last``).  The numbered rows are
    staged once; reading them again is a scan and a join with the offsets, which has one row for
    each group and task that share rows: no more than groups plus tasks.
    """
    parts = numbered_parts(df, group_cols, order_cols, last)
    task = F.shiftright("_at", TASK_BIT)
    before = Window.partitionBy(*group_cols).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(*group_cols, task.alias("_task"))
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(*group_cols, "_task", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias(
            "_shift"))
    )
    numbered = parts.withColumn("_task", task).join(F.broadcast(offsets), [*group_cols, "_task"])
    return numbered.withColumn(out_col, (F.col("_at") + F.col("_shift")).cast("int")).drop("_at", "_task", "_shift")


def calendar_sized(df: DataFrame) -> DataFrame:
    """Broadcast a table with one row per (index, review) at most.

    Its size is bounded by #indexes x #review dates (a calendar), not by the
    data volume: 1 000 indexes x 100 years of quarterly reviews is 400 000
    short rows, a few MB.
    """
    return F.broadcast(df)
