"""Ids in packed form: what a load moves is narrower, its rows are the same."""

import re

import pytest
from pyspark.sql import functions as F

from landstage.operators.keys import pack, unpack
from landstage.operators.lookup import lookup
from landstage.plans import model as M
from landstage.plans import registry, staging
from landstage.plans.spec import LoadSpec, Lookup, run_load, unmatched
from tests.test_staging import tables  # noqa: F401

TEXTS = ["", "a", "ab", "AB", "abc", "0abc", "aB", "é", "00", "\x01", "zz", "da39a3ee5e6b4b0d3255bfef95601890afd80709", " ab", None]


def test_packed_texts_come_back_and_differ_where_texts_do(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").withColumn("p", pack("t"))
    assert [r.u for r in df.select(unpack("p").alias("u")).collect()] == TEXTS
    assert df.where("p IS NOT NULL").select("p").distinct().count() == len(TEXTS) - 1
    assert df.where("length(t) = 40").select(F.length("p").alias("n")).first().n == 21


def test_unique_lookup_takes_the_smallest_text_not_the_smallest_bytes(spark):
    dim = spark.createDataFrame([("k", "ab"), ("k", "zz"), ("k", "b")], "k string, id string")
    got = lookup(spark.createDataFrame([("k",)], "x string"), dim, [("x", "k")], [("id", "id")], dim_unique=True, packed=["id"])
    assert got.select(unpack("id").alias("id")).first().id == "ab"


@pytest.fixture
def chain(spark):
    """Ids that are hex, not hex, null, or whole numbers; two rows of one dimension key; an id inside an expression."""
    spec = LoadSpec(
        name="t", source="land", target="out", source_table="land", select=(("n", "n"), ("a_id", "a_id"), ("c_id", "c_id"), ("d_id", "d_id")), hash_key=("n", "a_id"), hash_diff=("n", "c_id"),
        lookups=(Lookup("a", (("x", "x"),), (("id", "a_id"), ("no", "a_no"))), Lookup("b", (("a_id", "a_id"), ("a_no", "a_no")), (("id", "b_id"),)),
                 Lookup("c", (("upper(b_id)", "b_id"),), (("id", "c_id"),)), Lookup("d", (("c_id", "c_no"),), (("id", "d_id"),))))
    make = spark.createDataFrame
    return spec, {
        "land": make([(i, f"x{i % 5}") for i in range(12)] + [(12, None)], "n int, x string"),
        "a": make([("x0", "ab12", 1), ("x1", "AB12", 1), ("x2", None, 1), ("x3", "q", 1), ("x3", "q", 1)], "x string, id string, no int"),
        "b": make([("ab12", 1, "00ff"), ("AB12", 1, "b"), ("q", 1, "00ff"), ("q", 1, "00fe")], "a_id string, a_no int, id string"),
        "c": make([("00FF", "7"), ("B", "08")], "b_id string, id string"), "d": make([(7, "d7"), (8, "d8")], "c_no int, id string")}


def test_a_load_with_packed_ids_has_the_same_rows(spark, chain):
    spec, inputs = chain
    rows = lambda df: sorted(map(repr, df.collect()))
    plain = rows(run_load(spec, inputs, stamp=None))
    assert len(plain) == 10 and rows(run_load(spec, inputs, stamp=None, narrow=True)) == plain
    lost = rows(unmatched(spec, inputs))
    assert len(lost) == 7 and rows(unmatched(spec, inputs, narrow=True)) == lost


@pytest.mark.parametrize("query", ["fact_policy", "policy_unmatched"])
def test_the_landing_rows_are_shuffled_with_packed_ids(spark, tables, query):  # noqa: F811
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in off:
        spark.conf.set(key, "-1")
    try:
        df = registry.queries()[query](spark, tables)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # by the product: the id of the broker's client is the first of four keys
        assert re.search(r"SortMergeJoin \[__lk0l#\d+, __lk1l#\d+, __lk2l#\d+, __lk3l#\d+\]", plan)
        assert "unhex" in plan.split("SortMergeJoin")[-1]
        # the product is made distinct by the lookup's keys alone where they are unique
        assert ("p_retailprice" in plan) == (query == "fact_policy")
    finally:
        for key in off:
            spark.conf.unset(key)


def test_two_feeds_send_their_dimensions_with_packed_ids(spark, tables):  # noqa: F811
    """The driver builds what is sent whole; ids in letters are twice as wide there."""
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in off:
        spark.conf.set(key, "-1")
    try:
        df = registry.queries()["fact_policy_two_feeds"](spark, tables)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # the link of broker and client, for the landing rows and for both kinds of product rows
        assert len(re.findall(r"BroadcastExchange HashedRelationBroadcastMode\(List\(input\[0, binary[^\]]*\], input\[1, binary", plan)) >= 2
        assert "unhex" in plan.split("SortMergeJoin")[-1]
    finally:
        for key in off:
            spark.conf.unset(key)
    inputs = staging.two_feeds(spark, tables)
    plain = registry.comparable(run_load(staging.unique_lookups(M.POLICY), inputs, stamp=None))
    assert sorted(map(repr, df.collect())) == sorted(map(repr, plain.collect())) and df.count() > 0


def test_repeated_products_are_one_for_a_lookup_of_unique_keys(spark, tables):  # noqa: F811
    from landstage.plans.staging import product_rows
    product = product_rows(spark, tables)
    assert product.count() == 9 > product.distinct().count()        # a row for each line, as they are in the landing list
    got = registry.queries()["policy_unmatched"](spark, tables).collect()
    assert [(r.policy_number, r.missing) for r in got] and {r.missing for r in got} <= {M.STG_MEMBER, M.STG_PRODUCT}
    plain = unmatched(M.POLICY, dict(_plain(spark, tables)))
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain.select("policy_number", "id_number", "missing").collect()))


def _plain(spark, d):
    from landstage.plans.staging import written
    for name, df in written(spark, d, M.POLICY.needs()).items():
        yield name, df.where("gender = 'F'") if name == M.STG_MEMBER else df
