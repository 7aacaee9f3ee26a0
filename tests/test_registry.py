"""Every registered query against its DuckDB oracle on the smallest test tables."""

import hashlib
import math
import os

import duckdb
import pytest

from landstage.plans.registry import oracle_sql, queries
from landstage.plans.testbed import TABLES

SF = os.environ.get("LANDSTAGE_TEST_SF", "/root/testdata/sf0.001")


def _digest(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6))
        return str(v)

    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    assert sql is not None, f"{key} has no oracle"
    res = duck.execute(sql)
    names = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, names)
