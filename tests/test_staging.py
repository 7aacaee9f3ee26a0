"""The staging chain over the test tables: what a load makes Spark write, and how its lookups run."""

import datetime as dt
import os
import re
import time

import pytest

from landstage.plans import model as M
from landstage.plans import registry, staging
from landstage.plans.testbed import LINE_COLS, captured_list, order_lines, product_extract


@pytest.fixture
def tables(spark, tmp_path):
    """Three customers, one of them without orders; a line whose supplier's nation is unknown."""
    day = dt.datetime(1995, 3, 4)
    rows = {
        "nation": ([(0, "NATION_0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"Customer#{k}", 0, 1.0, "FURNITURE") for k in range(3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(0, "Supplier#0", 0, 1.0), (1, "Supplier#1", 9, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, "hot bolt", "Brand#1", "LARGE", k + 1, 9.5) for k in range(2)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k % 2, "O", 1.0, day, "5-LOW") for k in range(4)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k % 4, k % 2, 1 if k == 5 else 0, k % 3 + 1, day) for k in range(8)] + [(0, 0, 0, 1, day), (9, 0, 0, 1, day), (0, None, 0, 1, day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def shuffled_joins(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_dimension_load_writes_the_joined_rows_and_no_landing_list(spark, tables):
    got = registry.queries()["dim_broker"](spark, tables).collect()
    assert [(r.broker_code, r.broker_name, r.broker_branch) for r in got] == [("0", "Supplier#0", "NATION_0")]
    made = staging._CACHE[staging._key(spark, tables)]
    assert set(made) == {staging.LINES, M.CAPTURED}
    assert made[staging.LINES].columns == list(LINE_COLS)
    # the texts of the list are not in the files, and only those a load names are made from them
    p = shuffled_joins(made[M.CAPTURED].select("broker_code", "broker"))
    assert "c_name" not in re.search(r"FileScan parquet \[l?[^\]]*s_suppkey[^\]]*\]", p).group()


def test_landing_lists_have_a_row_per_line(spark, tables):
    lines = order_lines(spark, tables)
    assert lines.count() == 9              # a line without its order or part is in no list
    assert product_extract(spark, tables, lines).count() == 9
    assert captured_list(spark, tables).count() == 8    # the supplier's nation is unknown
    assert captured_list(spark, tables, lines).exceptAll(captured_list(spark, tables)).count() == 0


def test_small_written_dimensions_do_not_shuffle_the_landing_rows(spark, tables):
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in off:
        spark.conf.set(key, "-1")
    try:
        for query in ("fact_policy", "policy_unmatched", "fact_policy_two_feeds"):
            p = shuffled_joins(registry.queries()[query](spark, tables))
            by = re.findall(r"SortMergeJoin \[([^\]]*)\]", p)
            # the member, the product and the landing list's own nation; broker, client and their link are sent whole
            assert len(by) == 3, by
    finally:
        for key in off:
            spark.conf.unset(key)


def test_the_landing_folder_has_all_rows_of_the_columns_a_load_names(spark, tables):
    files = spark.read.parquet(staging.landing_files(spark, tables, M.CAPTURED, M.AGENT.dedupe))
    assert files.columns == list(M.AGENT.dedupe)
    assert files.count() == 8
    assert registry.queries()["incremental_dim_agent"](spark, tables).count() == 1


def test_tables_of_runs_are_written_with_zstd(spark, tmp_path):
    from landstage.sinks import write_run
    path = tmp_path / "t"
    write_run(spark.range(3).selectExpr("id", "sha1(string(id)) h"), "zstd_runs", "1", path=str(path))
    try:
        assert spark.table("zstd_runs").count() == 3
        assert list(path.rglob("*.zstd.parquet"))
    finally:
        spark.sql("DROP TABLE zstd_runs")


def test_what_a_staging_write_shuffles_is_removed_when_it_ends(spark, tables):
    def shuffled():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for top in root for d, _, fs in os.walk(top) for f in fs if f.startswith("shuffle_")}

    before = shuffled()
    frame = spark.range(2000).selectExpr("id % 7 AS k", "id").repartition(3, "k")
    put = staging._put(spark, frame)
    until = time.time() + 20                # they are removed beside the next work
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before and frame.columns == ["k", "id"]     # the frame is still there
    assert put.count() == 2000


def test_joined_rows_carry_an_order_key_once_and_take_suppliers_last(spark, tables):
    df = order_lines(spark, tables)
    assert df.where("o_orderkey = l_orderkey").count() == df.count() == 9
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # the first join from the top is the suppliers', and what is below it has no second key of the order
    assert re.search(r"Join Inner, \((\w+)#\d+L? = (\w+)#\d+L?\)", p).groups() == ("l_suppkey", "s_suppkey")
    below = re.search(r"Project \[([^\]]*)\]\n[^\n]*Join Inner, \(o_custkey", p).group(1)
    assert "l_orderkey" in below and "o_orderkey" not in below
