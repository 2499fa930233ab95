"""Benchmark the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed completely through the no-op sink (no collect to the driver); the time per query is the
best of $BENCH_REPEATS runs, ``value`` is the sum of those times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flatwatch.plans.catalog import QUERIES  # noqa: E402
from flatwatch.session import build_session  # noqa: E402

HEADLINE = (
    "city_summary_history",     # the accumulated summary: the benchmark named in the baseline
    "city_summary",
    "main_city_summary",
    "enrich_listings",
    "price_text_parse",
    "city_dictionary_lookup",
    "city_dictionary_lookup_large",
    "rooms_first_char",
    "page_items",
    "page_items_skip_promoted",
    "page_title",
    "snapshot_city_summary",
    "portal_ingest_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in HEADLINE if n in QUERIES]
    spark = build_session(f"local[{cpus}]", app="flatwatch-bench", shuffle_partitions=max(8, 2 * cpus))
    times = {}
    for name in names:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
