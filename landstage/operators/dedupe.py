"""Duplicate removal on key columns or derived keys.

``distinct`` over the key projection is a hash aggregate with a map-side
partial step: duplicates collapse before the shuffle, so a key that holds
a large share of the rows sends at most one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.functions.util import as_col


def key_columns(keys, df: DataFrame | None = None) -> list:
    if isinstance(keys, (str,)):
        keys = [keys]
    return [as_col(k, df) for k in keys]


def dedupe(df: DataFrame, keys=None, keep_count: bool = False, count_name: str = "count") -> DataFrame:
    """Distinct rows of ``keys`` (all columns when None); optionally with the group size."""
    cols = key_columns(keys, df) if keys is not None else [F.col(f"`{c}`") for c in df.columns]
    if keep_count:
        return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_name))
    return df.select(*cols).distinct()


def row_hash(keys, df: DataFrame | None = None):
    """64 bits of the key columns: equal rows have equal hashes, other rows nearly always different ones."""
    return F.xxhash64(*key_columns(keys, df))


def repeated_hashes(df: DataFrame, keys, name: str = "__row_hash") -> DataFrame:
    """The hashes that more than one row has; only the hashes are shuffled, not the rows."""
    counts = df.select(row_hash(keys, df).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1").select(name)


def dedupe_repeated(df: DataFrame, keys, repeated: DataFrame) -> DataFrame:
    """``dedupe`` for rows that are mostly distinct: ``repeated`` are their ``repeated_hashes``, few enough to broadcast.

    A row with a hash of its own equals no other row and stays where it is; only the rest
    are shuffled and compared, on all their columns, so a chance match of hashes costs nothing but that.
    """
    name, = repeated.columns
    rows = df.select(*key_columns(keys, df))
    rows = rows.withColumn(name, row_hash(rows.columns, rows))
    few = F.broadcast(repeated)
    alone = rows.join(few, name, "left_anti").drop(name)
    return alone.union(rows.join(few, name, "left_semi").drop(name).distinct())
