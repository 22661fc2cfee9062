"""Execute queries and summarise their final (AQE) physical plans.

Usage: python tools/explain_plans.py [SF_DIR] query ...   -> markdown on stdout
Keeps the operators that matter for scale: exchanges, join strategies,
window limits, aggregates, scans with their pushed filters and read schema.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from constella.plans.queries import QUERIES  # noqa: E402
from constella.session import build_session  # noqa: E402

KEEP = re.compile(
    r"(Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|"
    r"WindowGroupLimit|Window |HashAggregate|ObjectHashAggregate|SortAggregate|Generate|FileScan|"
    r"InMemoryTableScan|ArrowEvalPython|FlatMapGroupsInPandas)"
)


def summarise(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: [^,]+, ", "", line)
            out.append(line[:220])
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = build_session()
    for name in args:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### `{name}`\n\n```")
        print("\n".join(summarise(plan)))
        print("```\n")


if __name__ == "__main__":
    main()
