"""A distinct for which only the rows with a repeated hash are shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from landstage.operators import dedupe, dedupe_repeated, repeated_hashes
from landstage.plans import model as M
from landstage.plans import registry, staging
from landstage.plans.spec import run_load
from tests.test_staging import tables  # noqa: F401


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("all_hashes", [False, True])
def test_distinct_of_the_repeated_rows_alone_is_the_whole_distinct(spark, all_hashes):
    data = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), (None, None, None), (None, None, None), ("b", "c", 0.0), ("b", "c", -0.0), ("x", "", 2.0), ("", "x", 2.0)]
    df = spark.createDataFrame(data, "s string, t string, v double").repartition(3)
    keys = ["upper(s)", "t", "v"]
    # hashes that only one row has do no harm
    repeated = df.select(F.xxhash64(F.upper("s"), "t", "v").alias("__row_hash")) if all_hashes else repeated_hashes(df, keys)
    assert rows(dedupe_repeated(df, keys, repeated.distinct())) == rows(dedupe(df, keys))
    assert dedupe(df, keys).count() == 6


def test_rows_with_a_hash_of_their_own_are_not_shuffled(spark, tables):  # noqa: F811
    df = registry.queries()["dim_product"](spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    alone, again = re.split(r"LeftSemi", plan, maxsplit=1)
    assert "LeftAnti" in alone and "Union" in alone
    # above the join of the repeated rows: one exchange, their own; the others have none
    assert alone.count("Exchange hashpartitioning") == 1 and alone.index("LeftAnti") < alone.index("Exchange hashpartitioning")
    assert staging._get(spark, tables, staging.REPEATED).count() > 0


def test_product_is_the_same_with_few_and_with_many_repeated_rows(spark, tables, monkeypatch):  # noqa: F811
    few = rows(registry.queries()["dim_product"](spark, tables))
    monkeypatch.setattr(staging, "BROADCAST_ROWS", -1)
    many = registry.queries()["dim_product"](spark, tables)
    assert "LeftAnti" not in many._jdf.queryExecution().executedPlan().toString()
    assert few and rows(many) == few
    inputs = staging.written(spark, tables, M.PRODUCT.needs())
    assert rows(registry.comparable(run_load(M.PRODUCT, inputs, stamp=None))) == few
