"""Summarise the final (adaptive) physical plan of every registered query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts per query: Parquet scans, shuffle exchanges, broadcast exchanges,
join strategies, reused exchanges/stages, Python evaluation nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from landstage.plans.registry import queries  # noqa: E402
from landstage.session import local_session  # noqa: E402

PATTERNS = {
    "scans": r"FileScan \w+|Scan parquet|BatchScan",
    "shuffles": r"(?<!, )(?<!Reused)Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcasts": r"(?<!, )BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "reused": r"ReusedExchange",
    "python": r"ArrowEvalPython|BatchEvalPython|MapInPandas|PythonMapInArrow",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
}


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    qs = queries()
    print(f"# Final physical plans ({d}, local[8], AQE on)\n")
    print("Counted on the executed adaptive plan (`isFinalPlan=true`) of each registered query.")
    print("`shuffles` and `broadcasts` count exchanges that run; `reused` counts exchanges")
    print("computed once and read again (`ReusedExchange`).\n")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("| --- |" + " --- |" * len(PATTERNS))
    for name, fn in qs.items():
        df = fn(spark, d)
        df._jdf.queryExecution().toRdd().count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        counts = [len(re.findall(p, final)) for p in PATTERNS.values()]
        print(f"| `{name}` | " + " | ".join(str(c) for c in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
