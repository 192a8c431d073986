"""Print the operators Spark chose for headline queries (physical plans from
static estimates; adaptive execution may refine joins at run time): joins,
exchanges, window limits, Python evaluation, and each scan's pushed filters /
read schema.

usage: python scripts/plan_report.py [sf_dir] [name ...] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspark.plans.queries import QUERIES  # noqa: E402
from shelfspark.session import get_spark  # noqa: E402

OPS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "Exchange hashpartitioning", "Exchange SinglePartition",
       "WindowGroupLimit", "Window ", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
       "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
       "TakeOrderedAndProject", "Generate", "ReusedExchange", "AQEShuffleRead"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["curate_full", "latest_per_key", "category_cascade",
                             "case_dimensions", "publish_manifest", "recent_sales_lookup",
                             "id_batches", "changes_upsert"]
    spark = get_spark("local[8]", 16)
    print(f"# Physical plans ({sf})\n")
    for n in names:
        df = QUERIES[n](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = Counter({op.strip(): plan.count(op) for op in OPS if plan.count(op)})
        print(f"## {n}\n")
        print("operators: " + ", ".join(f"{k} x{v}" for k, v in sorted(c.items())) + "\n")
        scans = set()
        for line in plan.splitlines():
            m = re.search(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\].*?ReadSchema: (struct<[^>]*>)", line)
            if m:
                scans.add((m.group(3), m.group(2)))
        for rs, pf in sorted(scans):
            print(f"- scan `{rs}` pushed `[{pf[:120]}]`")
        print()


if __name__ == "__main__":
    main()
