"""The small reusable job shapes: stamp everything, select/rename/stamp,
explode + encode fields, relationalize + encode a nested field.

Fixed values: the output column names and the source literal below are the
ones these job shapes write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.functions.audit import now
from landstage.functions.dates import format_ts
from landstage.functions.text import to_utf8
from landstage.functions.util import as_col
from landstage.operators.nesting import explode_field, relationalize

# ---- fixed values: column names and source literal of the job shapes -------
STAMP_ALL_COLUMN = "LOAD_DTS"
SELECT_STAMP_COLUMN = "this_is_timestamp"
EXPLODE_SOURCE_COLUMN = "source_id"
EXPLODE_TIME_COLUMN = "timestamp"
EXPLODE_TIME_FORMAT = "MM/dd/yyyy hh:mm:ss"
RELATIONALIZE_KEY_COLUMN = "TESTKEY"
RELATIONALIZE_SOURCE_COLUMN = "SRC_FOR_ID"
RELATIONALIZE_TIME_COLUMN = "DTS"
SOURCE_LITERAL = "this_is_my_source"


def stamp_all(df: DataFrame, at=None, column: str = STAMP_ALL_COLUMN) -> DataFrame:
    """Every column plus the load time."""
    return df.select("*", now(at).alias(column))


def select_rename_stamp(df: DataFrame, columns: Sequence, at=None,
                        column: str = SELECT_STAMP_COLUMN) -> DataFrame:
    """Chosen columns (``name`` or ``(expression, new name)``) plus the load time."""
    cols = [as_col(c) if isinstance(c, str) else as_col(c[0]).alias(c[1]) for c in columns]
    return df.select(*cols, now(at).alias(column))


def explode_encode(df: DataFrame, array_column: str, fields: Sequence[str],
                   names: Sequence[str] | None = None, keep: Sequence[str] = (),
                   source: str = SOURCE_LITERAL, at=None) -> DataFrame:
    """One row per array element; chosen element fields as UTF-8 binary, the
    source literal and the load time as ``MM/dd/yyyy hh:mm:ss`` text."""
    names = list(names or [f"relational_{i}" for i in range(1, len(fields) + 1)])
    ex = explode_field(df, array_column, "__exploded", keep=keep)
    return ex.select(*keep,
                     *[to_utf8(F.col("__exploded").getField(f)).alias(n) for f, n in zip(fields, names)],
                     F.lit(source).alias(EXPLODE_SOURCE_COLUMN),
                     format_ts(now(at), EXPLODE_TIME_FORMAT).alias(EXPLODE_TIME_COLUMN))


def relationalize_encode(df: DataFrame, field: str, key: Sequence[str] | None = None,
                         name: str = "root", source: str = SOURCE_LITERAL, at=None) -> DataFrame:
    """Flatten ``df``, then take one flattened field of the root frame as UTF-8
    binary with the source literal and the load time."""
    root = relationalize(df, name, key=key)[name]
    return root.select(to_utf8(F.col(f"`{field}`")).alias(RELATIONALIZE_KEY_COLUMN),
                       F.lit(source).alias(RELATIONALIZE_SOURCE_COLUMN),
                       now(at).alias(RELATIONALIZE_TIME_COLUMN))
