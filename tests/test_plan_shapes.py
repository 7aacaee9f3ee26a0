"""Physical-plan properties the scale design relies on."""

import re

import pyspark.sql.functions as F

from landstage.functions import chop_prefix, to_double
from landstage.operators import dedupe, lookup, unpivot_cross
from landstage.plans.cleaning import clean_and_nest


def plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final_plan(df) -> str:
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_aggregates_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.lit("x").alias("v"))
    p = dedupe(df, ["k", "v"])._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange, final above it
    assert p.count("HashAggregate") == 2 and "Exchange hashpartitioning" in p


def test_small_dim_lookup_is_broadcast_and_large_is_not_forced(spark):
    left = spark.range(10000).select((F.col("id") % 50).alias("k"), "id")
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert "BroadcastHashJoin" in plan(lookup(left, dim, ["k"], ["v"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = final_plan(lookup(left, dim, ["k"], ["v"]))
        assert "BroadcastHashJoin" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lookup_prunes_the_dimension_scan(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("wide1"), F.lit("b").alias("wide2"),
                           (F.col("id") + 1).alias("v")).write.parquet(path)
    dim = spark.read.parquet(path)
    left = spark.range(100).select((F.col("id") % 20).alias("k"))
    p = plan(lookup(left, dim, ["k"], ["v"]))
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "wide1" not in read and "wide2" not in read
    assert "PushedFilters: [IsNotNull(k)]" in p  # pushed to the Parquet scan


def test_clean_and_nest_pushes_not_null_and_runs_no_python(spark, tmp_path):
    path = str(tmp_path / "prov")
    spark.createDataFrame(
        [("D", "12", "n", "c", "s", 1, "r", "$1", "$2", "$3"), ("D", None, "n", "c", "s", 1, "r", "$1", "$2", "$3")],
        "`drg definition` string, `provider id` string, `provider name` string, `provider city` string,"
        " `provider state` string, `provider zip code` long, `hospital referral region description` string,"
        " `average covered charges` string, `average total payments` string, `average medicare payments` string"
    ).write.parquet(path)
    out = clean_and_nest(spark.read.parquet(path))
    p = plan(out)
    assert "PushedFilters: [IsNotNull(`provider id`)]" in p
    assert "EvalPython" not in p
    assert out.count() == 1


def test_chop_prefix_stays_in_codegen(spark):
    df = spark.range(5).select(to_double(chop_prefix(F.concat(F.lit("$"), F.col("id").cast("string")))).alias("x"))
    p = plan(df)
    assert "EvalPython" not in p and "[codegen id" in p


def test_cross_unpivot_shuffles_its_parent_once(spark):
    base = spark.range(2000).select((F.col("id") % 100).alias("m"),
                                    (F.col("id") % 3).cast("string").alias("a1"),
                                    (F.col("id") % 5).cast("string").alias("a2"),
                                    (F.col("id") % 2).cast("string").alias("b1"),
                                    F.lit(None).cast("string").alias("b2"))
    parent = dedupe(base, ["m", "a1", "a2", "b1", "b2"])
    out = unpivot_cross(parent, "m", {"a": ["a1", "a2"], "b": ["b1", "b2"]})
    # the parent's distinct and the rows by key; the heavy keys' branch is empty and gone
    assert final_plan(out).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 2


def test_cross_unpivot_replicates_nothing_by_default(spark):
    """No key of this frame is heavy: the buckets' branch is empty and the sets need one exchange by key."""
    base = spark.range(2000).select((F.col("id") % 100).alias("m"), *[(F.col("id") % k).cast("string").alias(f"{g}{k}") for g in "abcde" for k in (2, 3)])
    out = unpivot_cross(base, "m", {g: [f"{g}2", f"{g}3"] for g in "abcde"})
    final = final_plan(out).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and "ShuffledHashJoin" not in final and "sequence(0" not in final
    # the count per key that finds heavy keys, the sets, the (empty) large products
    assert final.count("Exchange hashpartitioning") <= 3


def test_slot_load_shuffles_the_landing_side_twice(spark):
    from landstage.plans import model as M
    from landstage.plans.spec import run_load
    cols = ["first_name", "last_name", "id_number", *M.beneficiary_slot_columns()]
    land = spark.range(200).select(*[(F.col("id") % 7).cast("string").alias(c) for c in cols])
    member = spark.range(7).select(*[F.col("id").cast("string").alias(c) for c in cols[:3]])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = final_plan(run_load(M.MEMBER_BENEFICIARY, {M.CAPTURED: land, M.STG_MEMBER: member}, stamp=None))
        final = p.split("== Initial Plan ==")[0]
        assert final.count("Exchange hashpartitioning") <= 3        # landing, member, distinct
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_relationalized_children_scan_their_own_array_only(spark, tmp_path):
    from landstage.operators import relationalize
    spark.range(50).select("id", F.struct((F.col("id") % 3).alias("x")).alias("s"), F.array("id", F.col("id") + 1).alias("one"),
                           F.array(F.col("id").cast("string")).alias("two"), F.array(F.struct("id")).alias("three")).write.parquet(str(tmp_path / "n"))
    nested = spark.read.parquet(str(tmp_path / "n"))

    def read(df):
        return re.findall(r"ReadSchema: struct<(.*)>", df._jdf.queryExecution().executedPlan().toString())

    frames = relationalize(nested, "r")                    # ids from all columns, in one written pass
    assert read(frames["r_one"]) == ["one:array<bigint>,__rid:string"] and read(frames["r_two"]) == ["two:array<string>,__rid:string"]
    keyed = relationalize(nested, "r", key=["id"])         # ids from the key, nothing written
    assert read(keyed["r_one"]) == ["id:bigint,one:array<bigint>"]
    assert frames["r_one"].count() == keyed["r_one"].count() == 100
    linked = frames["r"].join(frames["r_two"], frames["r"]["two"] == frames["r_two"]["id"])
    assert linked.count() == 50 and linked.where(F.col("`two.val`") == frames["r"]["id"].cast("string")).count() == 50
