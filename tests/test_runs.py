"""Runs and their ledger, bucketed jobs, flagged lookups, database reads."""

import os
import re
import time

import pyspark.sql.functions as F
import pytest
from pyspark.sql import Observation

from landstage.operators.keys import with_surrogate_id
from landstage.plans import model as M
from landstage.plans.jobs import build_job, run_job
from landstage.plans.spec import flagged, run_load, unmatched
from landstage.plans.stores import Database, range_options
from landstage.session import FILE_CLEANUP, shuffles_freed
from landstage.sinks import finished, finished_files, record_run, runs, write_run, write_table
from test_bucketing import NO_BROADCAST


@pytest.fixture
def names(spark, tmp_path):
    made = []

    def name(n):
        made.append(n)
        return n
    yield name
    for n in made:
        for t in (n, f"{n}_runs"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_run_replaces_its_own_rows(spark, names, tmp_path):
    t = names("ls_runs_a")
    write_run(spark.range(5), t, "it's 1/2", path=str(tmp_path / "t"))
    write_run(spark.range(3), t, "b")
    write_run(spark.range(10, 12), t, "it's 1/2")
    assert rows(spark.table(t)) == sorted([(0, "b"), (1, "b"), (2, "b"), (10, "it's 1/2"), (11, "it's 1/2")], key=str)
    write_run(spark.range(0), t, "b")                       # a run without rows leaves none of its old ones
    assert rows(spark.table(t)) == [(10, "it's 1/2"), (11, "it's 1/2")]
    write_run(spark.range(1).withColumn("id", F.lit(7).cast("long")), t, "c")
    assert spark.table(t).count() == 3


def test_only_done_runs_are_read(spark, names):
    t = names("ls_runs_b")
    for run, state in (("a", "done"), ("b", "running"), ("c", "done")):
        record_run(spark, t, run, "running")
        write_run(spark.range(2).withColumn("r", F.lit(run)), t, run)
        record_run(spark, t, run, state, {"n": 2} if state == "done" else None)
    assert {r.r for r in finished(spark, t).collect()} == {"a", "c"}
    assert {(r.load_run, r.state, r.counts and r.counts["n"]) for r in runs(spark, t).collect()} == {("a", "done", 2), ("b", "running", None), ("c", "done", 2)}
    record_run(spark, t, "b", "done")
    assert finished(spark, t).count() == 6 and runs(spark, t).count() == 3
    assert "PartitionFilters: [isnotnull(load_run" in finished(spark, t)._jdf.queryExecution().executedPlan().toString()


def test_plain_tables_have_no_runs(spark, names, tmp_path):
    t = names("ls_runs_c")
    write_table(spark.range(2), t, path=str(tmp_path / "p"))
    with pytest.raises(ValueError, match="not kept by runs"):
        write_run(spark.range(2), t, "a")
    assert finished(spark, t).count() == 2


EXT = [("B1", "Acme", "Big Co"), ("B1", "Acme", "Big Co"), ("B2", "Zeta", "Small Co"), ("B3", "ACME", "Big Co")]


def test_the_same_job_run_twice_leaves_its_rows_once(spark, names):
    ext = "lsr_landing_product_extract_list"
    spark.createDataFrame(EXT, "broker_code string, broker_name string, client string").createOrReplaceTempView(ext)
    for n in ("broker", "client", "broker_client"):
        names(f"lsr_staging_{n}")
    for _ in range(2):
        for load, sid in (("broker_from_extract", "broker_id"), ("client_from_extract", "client_id"), ("broker_client", "broker_client_id")):
            run_job(spark, load, prefix="lsr_", surrogate=sid, run_id="day 1", buckets=4)
    assert [spark.table(f"lsr_staging_{n}").count() for n in ("broker", "client", "broker_client")] == [3, 2, 3]
    ledger = runs(spark, "lsr_staging_broker_client").collect()
    assert len(ledger) == 1 and ledger[0].state == "done"
    # lookups compare upper-cased landing names with names as staged: nothing is lost
    assert ledger[0].counts == {"matched": 3, "lost_staging_broker": 0, "lost_staging_client": 0}
    run_job(spark, "client_from_extract", prefix="lsr_", surrogate="client_id", run_id="day 2", buckets=4)
    assert spark.table("lsr_staging_client").count() == 4
    with pytest.raises(ValueError, match="run_id"):
        run_job(spark, "client_from_extract", prefix="lsr_", buckets=4)
    spark.catalog.dropTempView(ext)


def test_fact_reads_bucketed_dimensions_without_shuffling_them(spark, names):
    """Broadcasts off: one shuffle of the landing side for each of the five key sets, none of a dimension."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    dims = {M.STG_MEMBER: "m", M.STG_BROKER: "b", M.STG_CLIENT: "c", M.STG_BROKER_CLIENT: "l", M.STG_PRODUCT: "p"}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        for target in dims:
            cols = dict.fromkeys([*M.lookup_keys(target), *(t for lk in M.POLICY.lookups if lk.dim == target for t, _ in lk.take)])
            df = spark.range(50).select(*[(F.col("id") % 7).cast("int" if c == "cover" else "string").alias(c) for c in cols])
            write_run(df.distinct(), names(f"lsb_{target}"), "r", bucket_by=(8, M.lookup_keys(target)))
            record_run(spark, f"lsb_{target}", "r", "done")
        wanted = {c for lk in M.POLICY.lookups for c in ("last_name", "first_name", "id_number", "broker_code", "broker", "client", "policy_description", "cover", "member_type")}
        land = spark.range(500).select(*[(F.col("id") % 7).cast("string").alias(c) for c in sorted(wanted | {"policy_number", "capture_date", "inception", "status"})])
        land.createOrReplaceTempView(f"lsb_{M.CAPTURED}")
        fact = build_job(spark, "policy", prefix="lsb_", stamp=None)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == len(M.POLICY.lookups) == 5
        assert plan.count("Bucketed: true") == 5
        assert fact.count() == 500
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.catalog.dropTempView(f"lsb_{M.CAPTURED}")


def test_every_dimension_has_one_lookup_key():
    for spec in M.LOADS.values():
        for lk in spec.lookups:
            assert set(M.lookup_keys(lk.dim)) == {c for _, c in lk.on}
    assert M.lookup_keys(M.STG_POLICY) == ()


def fact_inputs(spark):
    ext = spark.createDataFrame([(f"P{i}", "d", str(i % 4), "10", "m", f"c{i % 3}", f"b{i % 5}", f"n{i % 5}", f"f{i}", f"l{i}", f"i{i}", "01/02/2024", "01/02/2024", "s") for i in range(60)],
                                "policy_number string, policy_description string, cover string, x string, member_type string, client string, broker_code string, broker string, first_name string, last_name string, id_number string, capture_date string, inception string, status string")
    member = spark.createDataFrame([(f"F{i}", f"L{i}", f"i{i}", f"M{i}") for i in range(50)], "first_name string, last_name string, id_number string, member_id string")
    broker = spark.createDataFrame([(f"b{i}", f"N{i}", f"B{i}") for i in range(4)], "broker_code string, broker_name string, broker_id string")
    client = spark.createDataFrame([(f"C{i}", f"K{i}") for i in range(3)], "client_name string, client_id string")
    link = spark.createDataFrame([(f"B{i}", f"K{j}", f"B{i}K{j}") for i in range(4) for j in range(3) if i + j], "broker_id string, client_id string, broker_client_id string")
    product = spark.createDataFrame([(f"B{i}K{j}", "d", c, "m", f"p{i}{j}{c}") for i in range(4) for j in range(3) for c in (0, 1, 2)],
                                    "broker_client_id string, policy_description string, cover int, relate_to string, product_id string")
    return {M.CAPTURED: ext, M.STG_MEMBER: member, M.STG_BROKER: broker, M.STG_CLIENT: client, M.STG_BROKER_CLIENT: link, M.STG_PRODUCT: product}


def test_counts_come_from_the_loads_own_run(spark):
    inputs = fact_inputs(spark)
    counts = Observation("own-run")
    got = rows(run_load(M.POLICY, inputs, stamp=None, counts=counts))
    assert got == rows(run_load(M.POLICY, inputs, stamp=None))
    assert counts.get["matched"] == len(got)
    lost = {r.missing: r.n for r in unmatched(M.POLICY, inputs).groupBy("missing").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k.removeprefix("lost_"): n for k, n in counts.get.items() if n and k != "matched"} == lost and len(lost) == 4
    # rows 0..59 once each: lost or matched
    assert sum(lost.values()) + len(got) == 60
    assert unmatched(M.POLICY, inputs).columns == [*inputs[M.CAPTURED].columns, "missing"]


def test_a_row_that_meets_two_dimension_rows_counts_for_each(spark):
    inputs = fact_inputs(spark)
    inputs[M.STG_MEMBER] = inputs[M.STG_MEMBER].union(inputs[M.STG_MEMBER].where("member_id = 'M0'"))
    counts = Observation("two-ways")
    got = run_load(M.POLICY, inputs, stamp=None, counts=counts).count()
    assert sum(counts.get.values()) == 61 and counts.get["matched"] == got
    assert unmatched(M.POLICY, inputs).where("policy_number = 'P0'").count() == 1


def test_unmatched_is_one_pass(spark):
    plan = unmatched(M.POLICY, fact_inputs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 5 and "LeftAnti" not in plan and plan.count("Join Inner") == 0


def test_a_missed_row_matches_nothing_more(spark):
    """The broker lookup would meet two rows, but the row has missed its member before."""
    inputs = fact_inputs(spark)
    inputs[M.STG_MEMBER] = inputs[M.STG_MEMBER].where("false")
    inputs[M.STG_BROKER] = inputs[M.STG_BROKER].union(inputs[M.STG_BROKER])
    out = flagged(M.POLICY, inputs)
    assert out.count() == 60 and out.where("broker_id is not null or client_id is not null").count() == 0


def test_a_run_in_slices_has_the_rows_and_counts_of_a_whole_run(spark, names, tmp_path):
    """More slices than some have rows; executed twice; small dimensions sent whole with packed ids."""
    inputs = fact_inputs(spark)
    some = inputs[M.CAPTURED].where("length(policy_number) = 2")
    inputs[M.CAPTURED] = some.union(some.where("policy_number < 'P3'")).selectExpr(
        "*", "if(policy_number = 'P7', null, status) AS s").drop("status").withColumnRenamed("s", "status")
    for n, df in inputs.items():
        df.createOrReplaceTempView(f"lss_{n}")
    counts = Observation("whole-run")
    whole = rows(run_load(M.POLICY, inputs, stamp=None, counts=counts))
    t, path = names(f"lss_{M.STG_POLICY}"), str(tmp_path / "p")
    for _ in range(2):
        run_job(spark, "policy", prefix="lss_", stamp=None, run_id="a b", send=(M.STG_BROKER, M.STG_CLIENT, M.STG_BROKER_CLIENT), slice_rows=3, path=path)
    assert rows(finished(spark, t)) == whole and len(whole) > 4
    ledger, = runs(spark, t).collect()
    assert ledger.state == "done" and ledger.counts == counts.get
    record_run(spark, t, "half", "running", path=f"{path}-runs")
    write_run(run_load(M.POLICY, inputs, stamp=None), t, "half", path=path)
    kept = finished_files(spark, t, path)
    spark.sql(f"DROP TABLE {t}")
    spark.sql(f"DROP TABLE {t}_runs")
    assert rows(kept) == whole                              # without the run that is not done
    with pytest.raises(ValueError, match="slices"):
        run_job(spark, "client", prefix="lss_", run_id="a", slice_rows=2)
    for n in inputs:
        spark.catalog.dropTempView(f"lss_{n}")


@pytest.mark.parametrize("few", [100, 0])
def test_a_bucketed_run_deals_its_rows_before_they_are_hashed(spark, names, few):
    """One exchange of landing texts, no hash in it; with few repeated hashes only rows with one are shuffled to be made distinct."""
    ext = spark.createDataFrame([(f"c{i % 40}", f"d{i % 7}", "m", "1", "2", "9.5", "1.25", f"{i % 3}.50", "x", "cat", "t", f"B{i % 4}", f"N{i % 4}", f"C{i % 3}", "u") for i in range(90)],
                                ", ".join(f"{c} string" for c in M.PRODUCT_COLS))
    broker = spark.createDataFrame([(f"B{i}", f"N{i}", sha) for i in range(4) for sha in ("ab12", f"q{i}")], "broker_code string, broker_name string, broker_id string")
    client = spark.createDataFrame([(f"C{i}", f"K{i}") for i in range(3)], "client_name string, client_id string")
    link = spark.createDataFrame([(b, f"K{j}", f"{i:040x}" if i else "Z") for i, b in enumerate(("ab12", "q1", "q2")) for j in range(3)], "broker_id string, client_id string, broker_client_id string")
    inputs = {M.PRODUCT_EXTRACT: ext, M.STG_BROKER: broker, M.STG_CLIENT: client, M.STG_BROKER_CLIENT: link}
    for n, df in inputs.items():
        df.createOrReplaceTempView(f"lsd_{n}")
    whole = rows(with_surrogate_id(run_load(M.PRODUCT, inputs, stamp=None), "product_id"))
    t = names(f"lsd_{M.STG_PRODUCT}")
    run_job(spark, "product", prefix="lsd_", surrogate="product_id", stamp=None, run_id="a", buckets=4, send=tuple(inputs), few=few, mostly_distinct=True)
    assert rows(finished(spark, t)) == whole and whole
    # a file for each bucket at most: the rows lay as the buckets want them
    files = [f.rsplit("_", 1)[1].split(".")[0] for f in spark.table(t).inputFiles()]
    assert len(files) == len(set(files)) <= 4
    keys = M.lookup_keys(M.STG_PRODUCT)
    out = run_load(M.PRODUCT, inputs, stamp=None, narrow=True, deal=(4, keys))
    moved = re.search(r"RepartitionByExpression[^\n]*\n[^\n]*Project \[([^\n]*)\]", out._jdf.queryExecution().optimizedPlan().toString()).group(1)
    assert "sha1" not in moved and "product_category" in moved
    assert rows(out) == rows(run_load(M.PRODUCT, inputs, stamp=None))
    for n in inputs:
        spark.catalog.dropTempView(f"lsd_{n}")


def test_what_a_run_shuffles_is_removed_when_it_ends(spark, names):
    """A frame that is still there holds its shuffle files otherwise."""
    def shuffled():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return sorted(f for top in root for d, _, fs in os.walk(top) for f in fs if f.startswith("shuffle_"))

    before = shuffled()
    frames = [spark.range(2000).selectExpr("id % 7 AS k", "id").repartition(3, "k") for _ in range(2)]
    write_run(frames[0], names("ls_runs_freed"), "a")
    until = time.time() + 20                                # they are removed beside the next work
    while set(shuffled()) - set(before) and time.time() < until:
        time.sleep(0.1)
    assert set(shuffled()) <= set(before)
    old = spark.conf.get(FILE_CLEANUP)
    with shuffles_freed(spark):
        assert spark.conf.get(FILE_CLEANUP) == "true"
    assert spark.conf.get(FILE_CLEANUP) == old
    frames[1].write.format("noop").mode("overwrite").save()
    assert set(shuffled()) - set(before)                    # as it is without


def test_ranges_follow_the_table():
    assert range_options("k", 1, 1000, 5_000_000, 1_000_000, 64) == {"partition_column": "k", "lower": 1, "upper": 1001, "num_partitions": 5}
    assert range_options("k", 1, 3, 5_000_000, 1_000_000, 64)["num_partitions"] == 3
    assert range_options("k", 1, 10**9, 10**9, 1_000_000, 64)["num_partitions"] == 64
    assert range_options("k", None, None, 0, 1_000_000, 64) == {}


def test_runs_need_the_catalog(spark):
    with pytest.raises(ValueError, match="catalog"):
        run_job(spark, "agent", store=Database("jdbc:none:"), run_id="a")
