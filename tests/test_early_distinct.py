"""Landing rows that are made distinct before they are shuffled for a lookup."""

import datetime as dt
import re

from landstage.plans import model as M
from landstage.plans import registry, staging
from landstage.plans.spec import run_load


def rows(df):
    return sorted(map(repr, df.collect()))


def test_beneficiary_rows_are_made_one_before_the_lookup(spark, tmp_path):
    """Members with many policies: one landing row of each is shuffled for the lookup, and the rows are those of the plain load."""
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    day = dt.datetime(1995, 3, 4)
    data = {
        "nation": ([(0, "NATION_0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"Customer#{k}", 0, 1.0, "FURNITURE") for k in range(4)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(0, "Supplier#0", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(0, "hot bolt", "Brand#1", "LARGE", 1, 9.5)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k % 4, "O", 1.0, day, "5-LOW") for k in range(8)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k % 8, 0, 0, k % 3 + 1, day) for k in range(800)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp"),
    }
    for name, (table, schema) in data.items():
        spark.createDataFrame(table, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = registry.queries()["load_member_beneficiary"](spark, str(tmp_path))
    inputs = staging.written(spark, str(tmp_path), M.MEMBER_BENEFICIARY.needs())
    assert rows(df) == rows(run_load(M.MEMBER_BENEFICIARY, inputs, stamp=None)) and df.count() == 1 + 2 + 3
    for key in off:
        spark.conf.set(key, "-1")
    try:
        plan = registry.queries()["load_member_beneficiary"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        # the lookup's exchange is of rows made distinct, which is begun before their first exchange
        line = r"[^\n]*\n[ :]*\+- "
        assert re.search(rf"Exchange hashpartitioning\(__lk0l{line}HashAggregate{line}Exchange hashpartitioning\([^\n]*beneficiary_{line}HashAggregate", plan)
    finally:
        for key in off:
            spark.conf.unset(key)
