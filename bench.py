"""Benchmark: headline queries on the driver tables.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1);
each query is executed to completion through the no-op sink (every row is
produced, nothing is collected), once to warm up and then $BENCH_RUNS times;
the median is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfspark.plans.queries import QUERIES, silver  # noqa: E402
from shelfspark.session import get_spark  # noqa: E402

HEADLINE = [
    "curate_full", "latest_per_key", "category_cascade", "case_dimensions", "coverage_metrics",
    "publish_manifest", "manifest_diff", "category_names", "recent_sales_lookup", "id_batches",
    "changes_upsert", "asset_walk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=parts)
    t0 = time.perf_counter()
    silver(spark, sf_dir)  # lands the raw documents that most queries read; timed on its own
    landing = round(time.perf_counter() - t0, 3)
    print(f"# landing of the raw documents: {landing}s", file=sys.stderr, flush=True)
    out = {}
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
        print(f"# {name}: {out[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {"metric": "headline_total_median_sec", "value": round(sum(out.values()), 3),
              "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else sf_dir,
              "runs": runs, "cpus": int(cpus), "landing_sec": landing}
    if "curate_full" in out:
        # raw documents parsed, ranked and curated per second (from the landed table)
        n_docs = silver(spark, sf_dir).count()
        result["curate_docs"] = n_docs
        result["curate_docs_per_sec"] = round(n_docs / out["curate_full"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
