"""Bench: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG_DIR (optional: write Spark's event log there for stage and
task times).
Each query is executed in full with the ``noop`` sink (no collect); the
value is the sum of the per-query wall times after an untimed warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from constella.plans.queries import QUERIES  # noqa: E402
from constella.session import build_session  # noqa: E402

HEADLINE = [
    "positions",
    "buffer_chain",
    "buffer_single",
    "constituents",
    "country_top10",
    "islands",
    "rank_events",
    "ranking_daily",
    "rank_gaps",
    "mcap_stats",
    "enrich_ids",
    "resolve_isin",
    "match_publications",
    "write_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), extra=extra)
    # Warm-up (untimed): JIT-compile the shared code paths on a small input.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    for name in ("buffer_chain", "rank_events", "enrich_ids"):
        QUERIES[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir).write.format("noop").mode(
            "overwrite"
        ).save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
