"""Run queries and print the operators that matter for scale from the final adaptive
plan: scans (pushed filters, read schema), exchanges, join strategies, window limits,
Python operators.

    python tools/plans.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "WindowGroupLimit",
         "HashAggregate", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "Generate")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from pickwise.plans.queries import REGISTRY
    from pickwise.session import build_session

    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    for key in args:
        df = REGISTRY[key](spark, sf_dir)
        df.collect()  # the frame's own execution: only then is its plan the final one
        plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
        counts = Counter()
        for line in plan.splitlines():
            op = re.sub(r"^[\s:+\-|*]*", "", line).split(" ")[0].split("(")[0]
            if op in KINDS:
                counts[op] += 1
        print(f"== {key}: " + ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())))
        for m in sorted(set(re.findall(r"(?:BroadcastHashJoin|SortMergeJoin) \[[^\]]*\], \[[^\]]*\], \w+", plan))):
            print("   join", re.sub(r"#\d+L?", "", m))
        for m in sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", plan))):
            print("   scan", m[:160])
    spark.stop()


if __name__ == "__main__":
    main()
