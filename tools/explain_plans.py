"""Print a per-query summary of the physical plan: exchanges, join and
aggregate strategies, windows, Python evaluation and pushed scan filters.

Usage: python tools/explain_plans.py [sf_dir] [query ...]   (add --full for explain("formatted"))
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.plans import catalog  # noqa: E402
from tidepool.session import build_session  # noqa: E402

OPS = re.compile(r"(Exchange \w+|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                 r"CartesianProduct|HashAggregate|SortAggregate|ObjectHashAggregate|Window|ArrowEvalPython|"
                 r"BatchEvalPython|Generate|PushedFilters: \[[^\]]*\])")


def main() -> None:
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or [n for n in catalog.QUERIES if n != "stream_window_metrics"]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = catalog.QUERIES[name](spark, sf_dir)
        if full:
            print(f"== {name}")
            df.explain("formatted")
            continue
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = OPS.findall(plan)
        counts = Counter(o for o in found if not o.startswith("PushedFilters"))
        pushed = sorted({o for o in found if o.startswith("PushedFilters") and o != "PushedFilters: []"})
        print(f"{name:26s} {dict(counts)}")
        for p in pushed[:3]:
            print(f"{'':26s} {p}")
    spark.stop()


if __name__ == "__main__":
    main()
