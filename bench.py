"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "...", "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed with a no-op sink (no driver collect); the
reported time is the best of $BENCH_REPEAT runs (default 2) after one
warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marginalia.plans import catalog  # noqa: E402
from marginalia.session import get_spark  # noqa: E402

HEADLINE = [
    "thread_rollup", "page_comment_summary", "comment_status_counts", "conversation_threads",
    "issue_summary", "issue_search", "issue_recent_comments",
    "hub_pages", "hub_markdown", "page_tree", "stale_exports",
    "page_text", "doc_text", "page_headings", "page_links", "part_markdown",
    "replace_sections", "guarded_changes", "apply_updates", "error_triage",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    # warm-up on the smallest scale (JIT, session start); not timed
    for warm in ("thread_rollup", "issue_search"):
        catalog.QUERIES[warm](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
