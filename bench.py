"""Benchmark headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5), BENCH_QUERIES (comma list),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus).  All queries run once to warm
up; then each query runs once more and BENCH_RUNS timed times, and the
median is reported.  A run executes the whole plan into the ``noop`` sink
(no rows are collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from landstage.plans.registry import queries  # noqa: E402
from landstage.session import local_session  # noqa: E402

HEADLINE = [
    "fact_policy", "load_member_beneficiary", "load_member_address", "dim_product",
    "link_broker_client", "dim_member", "dim_agent", "dedupe_keys", "hash_key_basic",
    "unpivot_cross", "unpivot_positional", "cast_decimal_tolerant", "clean_and_nest",
    "relationalize_child", "explode_struct_fields", "map_records_expr", "map_records_pandas",
    "lookup_upper_key",
]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2))))
    spark = local_session(cpus, shuffle_partitions=shuffle)
    qs = queries()
    times: dict[str, float] = {}
    # warm-up pass over every query first (JIT, staging tables, file listing),
    # so no query's timing carries another's start-up cost
    for name in names:
        qs[name](spark, d).write.format("noop").mode("overwrite").save()
    for name in names:
        samples = []
        for i in range(runs + 1):  # one more warm run right before the timed ones
            t0 = time.perf_counter()
            qs[name](spark, d).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", d)
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else d,
                      "cpus": cpus, "runs": runs, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
