"""Scalar functions written in Python, run over Arrow arrays.

``scalar_function`` is the hook for a function that the built-in ones cannot
express: declared result type, a rule for nulls, whole Arrow batches between
JVM and Python.  Where a built-in function exists, it is the better choice: it
stays in generated code (``text.chop_prefix`` is the built-in form of
``lambda x: x[1:]``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, _parse_datatype_string

from landstage.functions.util import as_col


def scalar_function(fn: Callable, returns: str | DataType, on_null: str = "null", vectorized: bool = False) -> Callable[..., Column]:
    """Column function of ``fn``.

    fn          -- takes one value per argument and returns a value; with ``vectorized``
                   takes one ``pyarrow`` array per argument and returns an array
    returns     -- result type (``string``, ``decimal(7,2)``, ...); results are cast to it
    on_null     -- ``null``: the result is null where any argument is, and ``fn`` never
                   sees a null value; ``call``: ``fn`` is called with nulls

    The arguments of the returned function are columns, names or SQL expressions.  All
    calls in one projection share one pass through Python.
    """
    if on_null not in ("null", "call"):
        raise ValueError(f"on_null is 'null' or 'call', not {on_null!r}")
    kind = _parse_datatype_string(returns) if isinstance(returns, str) else returns
    arrow = to_arrow_type(kind)

    def over_values(*arrays: pa.Array) -> pa.Array:
        return pa.array([fn(*row) for row in zip(*(a.to_pylist() for a in arrays), strict=True)], arrow)

    def run(*arrays: pa.Array) -> pa.Array:
        call = fn if vectorized else over_values
        if on_null == "call":
            return _typed(call(*arrays), arrow)
        there = reduce(pc.and_, [pc.is_valid(a) for a in arrays])
        if pc.all(there).as_py() is not False:
            return _typed(call(*arrays), arrow)
        # only the complete rows are given to fn; their results go back to their places
        found = _typed(call(*(a.filter(there) for a in arrays)), arrow)
        place = pc.if_else(there, pc.subtract(pc.cumulative_sum(there.cast(pa.int64())), 1), pa.scalar(None, pa.int64()))
        return found.take(place)

    udf = F.arrow_udf(run, kind)
    return lambda *cols: udf(*[as_col(c) for c in cols])


def _typed(out, arrow: pa.DataType) -> pa.Array:
    out = out.combine_chunks() if isinstance(out, pa.ChunkedArray) else out
    return out if out.type == arrow else out.cast(arrow)
