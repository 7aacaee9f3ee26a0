"""The driver contract in __spark_entry__.py."""

import importlib.util
import os
import re

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_entry_runs_with_a_stable_schema(spark, entry_module):
    a = entry_module.entry(spark)
    b = entry_module.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert {"policy_number", "member_id", "product_id", "hash_key", "hash_diff"} <= set(a.columns)


def test_every_load_query_has_an_oracle(entry_module):
    qs, sql = entry_module.queries(), entry_module.oracle_sql()
    own = {k for k in qs if not re.match(r"op\d+_|pipeline$", k)}
    assert own <= set(sql) <= set(qs)
    assert len(own) >= 57
