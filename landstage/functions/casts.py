"""Tolerant casts: a bad value becomes null instead of failing the job.

Spark 4 runs with ANSI mode on, where ``cast`` throws on bad text or
overflow.  Landing data is dirty, so every cast in a load goes through
``try_cast``.  Integer casts accept decimal text and truncate toward zero
(``'1000.50'`` -> 1000), like the non-ANSI cast landing jobs were written
against.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType, _parse_datatype_string

from landstage.functions.util import as_col

_INTEGRAL = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}


def _dtype(t) -> DataType:
    return t if isinstance(t, DataType) else _parse_datatype_string(t)


def tolerant_cast(c, to, from_type: DataType | None = None) -> Column:
    """``try_cast`` with text -> integer going through decimal(38,18) first.

    ``from_type`` (when known) skips a cast to the same type and lets numeric
    sources cast directly (fractions truncate toward zero either way).
    """
    col = as_col(c)
    dt = _dtype(to)
    if from_type is not None and from_type == dt:
        return col
    if isinstance(dt, IntegralType) and (from_type is None or isinstance(from_type, StringType)):
        return col.try_cast(DecimalType(38, 18)).try_cast(dt)
    return col.try_cast(dt)


def to_int(c) -> Column:
    return tolerant_cast(c, "int")


def to_long(c) -> Column:
    return tolerant_cast(c, "bigint")


def to_double(c) -> Column:
    return tolerant_cast(c, "double")


def to_decimal(c, precision: int = 7, scale: int = 2) -> Column:
    """Round half up to ``scale``; values that do not fit become null."""
    return tolerant_cast(c, DecimalType(precision, scale))
