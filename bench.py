"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full with the no-op sink (no driver collect);
the flagship runs once on the smallest scale first, so JVM and Python
worker start-up are not charged to a query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quarry.session import build_session  # noqa: E402
from quarry.plans.workloads import W  # noqa: E402

HEADLINE = [
    "search_run", "knn_batch", "scrape_run", "analyze_run", "index_run", "ingest_run",
    "embed_batch", "extract_text", "validate_response", "dedup_first", "latest_ok", "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="quarry-bench")
    # warm-up: the flagship once on the smallest scale (JIT, Python workers)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not Path(warm_dir).exists():
        warm_dir = sf_dir
    W["search_run"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        W[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
