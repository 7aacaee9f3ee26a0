"""Command line: ``python -m landstage <load> --database DB [--prefix P] [--stamp clock12] [--run-id R]``.

Loads: agent, broker, client, member, member_address, member_beneficiary,
policy, member_from_list, broker_from_extract, broker_client,
client_from_extract, product.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from landstage.plans.jobs import run_job
from landstage.plans.model import LOADS
from landstage.session import ensure_checkpoint_dir


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="landstage")
    ap.add_argument("load", choices=sorted(LOADS))
    ap.add_argument("--database", default=None)
    ap.add_argument("--prefix", default="", help="table-name prefix in the catalog")
    ap.add_argument("--target", default=None, help="staging table (default: the spec's)")
    ap.add_argument("--stamp", default="exact", choices=["exact", "clock12", "raw"])
    ap.add_argument("--surrogate", default=None, help="add a surrogate id column with this name")
    ap.add_argument("--run-id", default=None, help="write the rows as this run's; the same run again replaces them")
    ap.add_argument("--buckets", type=int, default=None, help="bucket the target on its lookup keys (with --run-id)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"landstage-{args.load}").getOrCreate()
    ensure_checkpoint_dir(spark)
    name = run_job(spark, args.load, args.database, args.prefix, args.target, stamp=args.stamp,
                   surrogate=args.surrogate, run_id=args.run_id, buckets=args.buckets)
    print(f"appended {args.load} -> {name}")


if __name__ == "__main__":
    main()
