"""A key holding a third of the rows: results stay whole, AQE splits the hot partition."""

import pyspark.sql.functions as F

from landstage.operators import dedupe, lookup

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
}


def skewed(spark, n=30000):
    # key 0 holds a third of the rows, the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("v"))


def test_skewed_lookup_is_split_and_complete(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        left = skewed(spark)
        dim = spark.range(1001).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
        out = lookup(left, dim, ["k"], ["w"])
        n = out._jdf.queryExecution().toRdd().count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert n == 30000
        assert "skew=true" in plan
        salted = lookup(left, dim, ["k"], ["w"], salt=8)
        assert salted.count() == 30000
        assert salted.agg(F.sum("w")).first()[0] == out.agg(F.sum("w")).first()[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_skewed_dedupe_combines_before_the_shuffle(spark):
    left = skewed(spark).select("k")
    out = dedupe(left, ["k"])
    assert out.count() == 1001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_skewed_cross_unpivot_is_complete(spark):
    from landstage.operators import unpivot_cross
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        # member 0 holds a third of the rows with 40 distinct a-values and 25 b-values
        base = spark.range(6000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("m"),
            (F.col("id") % 40).cast("string").alias("a1"), F.lit(None).cast("string").alias("a2"),
            (F.col("id") % 25).cast("string").alias("b1"), (F.col("id") % 2).cast("string").alias("b2"))
        out = unpivot_cross(base, "m", {"a": ["a1", "a2"], "b": ["b1", "b2"]})
        counts = {r.m: r.n for r in out.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}
        # member 0: (40 values + null) x 25 b-values (b2's 0/1 are among them)
        assert counts[0] == 41 * 25
        assert len(counts) == 201
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_of_five_groups_is_spread_over_tasks(spark):
    """One task makes the whole product of the hot key unless it is over the bound; only the hot key's is split."""
    from landstage.operators import unpivot_cross
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        names = ["a", "b", "c", "d", "e"]
        base = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100 + 1).alias("m"),
            *[((F.col("id") / (3 + 2 * i)).cast("long") % (24 if n == "a" else 4)).cast("string").alias(n) for i, n in enumerate(names)])

        def largest(spread, key="m = 0"):
            out = unpivot_cross(base, "m", {n: [n] for n in names}, spread=spread).where(key)
            sizes = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
            return max(sizes), sum(sizes), len(sizes)

        alone, total, tasks = largest(1_000_000)
        spread, same, many = largest(700)
        assert same == total == 24 * 4 ** 4 and tasks == 1 and alone == total
        assert many >= 3 and spread <= total * 2 // 3
        # keys under the bound are each made in one task
        others = unpivot_cross(base, "m", {n: [n] for n in names}, spread=1500).where("m != 0").select("m", F.spark_partition_id().alias("p"))
        keys = others.groupBy("m").agg(F.count_distinct("p").alias("tasks"), F.count(F.lit(1)).alias("n")).collect()
        assert len(keys) == 100 and {r["tasks"] for r in keys if r["n"] <= 1500} == {1}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
