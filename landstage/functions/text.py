"""Small text helpers that stay native (codegen) instead of Python lambdas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landstage.functions.util import as_col


def chop_prefix(c, n: int = 1) -> Column:
    """Drop the first ``n`` characters (``x[n:]``); null stays null."""
    return F.substring(as_col(c), n + 1, 2_147_483_647)


def to_utf8(c) -> Column:
    """``encode(cast(c as string), 'UTF-8')`` -> binary."""
    return F.encode(as_col(c).cast("string"), "UTF-8")
