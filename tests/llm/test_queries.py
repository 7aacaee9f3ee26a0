"""The operators' queries: one per operator, their SQL, and whole plans."""

from __future__ import annotations

import re

import duckdb
import pytest

from landstage.llm import registry
from tests.llm.data import SF

NATIVE = ("op2_decontamination", "op5_source_mixing")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in registry.queries()) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, key):
    df = registry.queries()[key](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(names).collect()), key=str)
    res = duck.execute(registry.oracle_sql()[key])
    columns = [c[0] for c in res.description]
    assert sorted(columns) == names
    assert got == sorted((tuple(r[columns.index(n)] for n in names) for r in res.fetchall()), key=str)


@pytest.mark.parametrize("key", NATIVE)
def test_native_queries_run_no_python(spark, key):
    plan = registry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
