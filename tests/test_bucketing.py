"""Bucketed staging tables: lookups read co-located buckets instead of shuffling."""

import pyspark.sql.functions as F

from landstage.operators import lookup
from landstage.sinks import write_table

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_bucketed_dimension_is_not_shuffled(spark, tmp_path):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        dim = spark.range(1000).select(F.col("id").cast("string").alias("member_key"),
                                       (F.col("id") * 7).alias("member_id"))
        write_table(dim, "ls_bucket_dim", mode="overwrite", bucket_by=(8, ["member_key"]),
                    path=str(tmp_path / "dim"))
        landing = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("member_key"),
                                           F.col("id").alias("v"))
        plain = lookup(landing, spark.table("ls_bucket_dim"), ["member_key"], ["member_id"])
        assert plain.count() == 5000
        assert _exchanges(plain) == 1          # only the landing side is shuffled

        write_table(landing, "ls_bucket_landing", mode="overwrite", bucket_by=(8, ["member_key"]),
                    path=str(tmp_path / "landing"))
        both = lookup(spark.table("ls_bucket_landing"), spark.table("ls_bucket_dim"), ["member_key"],
                      ["member_id"])
        assert both.count() == 5000
        assert _exchanges(both) == 0           # co-located: no shuffle at all
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS ls_bucket_dim")
        spark.sql("DROP TABLE IF EXISTS ls_bucket_landing")
