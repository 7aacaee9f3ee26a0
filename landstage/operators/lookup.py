"""Inner equi-lookups into dimension tables (key substitution).

A lookup joins a landing frame to a dimension on pairs of
(left expression, dimension column) and brings back chosen dimension
columns under new names.  The dimension side is pruned to exactly the key
and taken columns before the join, so both sides never carry clashing
names (hash_key, load_dts, ...) and the dimension scan reads only those
columns.

Join strategy
-------------
No hint is added: Catalyst broadcasts the
dimension when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with runtime
sizes; larger dimensions get a shuffle join, with AQE splitting skewed
partitions.  No size is counted and no hint is forced.  ``salt=n`` spreads each left key over ``n``
buckets (dimension rows replicated ``n`` times) for a key that holds a
large share of the rows in a shuffle join.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.functions.util import as_col
from landstage.operators.keys import pack


def _pairs(on) -> list[tuple]:
    if isinstance(on, Mapping):
        return list(on.items())
    out = []
    for item in on:
        if isinstance(item, str):
            out.append((item, item))
        else:
            out.append(tuple(item))
    return out


def _take(take) -> list[tuple[str, str]]:
    if take is None:
        return []
    if isinstance(take, Mapping):
        return list(take.items())
    return [(t, t) if isinstance(t, str) else tuple(t) for t in take]


def lookup(df: DataFrame, dim: DataFrame, on, take=None, *, how: str = "inner",
           dim_unique: bool = False, salt: int = 0,
           prefix: str = "__lk", flag: str | None = None, only=None, packed: Collection[str] = ()) -> DataFrame:
    """Join ``df`` to ``dim`` on ``on`` and append ``take`` columns.

    on    -- [(left expr, dim column), ...]; a bare name means same name on both sides
    take  -- {dim column: output name} or [names]
    dim_unique -- keep one dimension row per key (smallest taken values), so
                  duplicate dimension rows cannot fan out the landing rows
    flag  -- (left joins) name of a column that is true where a dimension row was found
    only  -- condition on ``df``: rows that do not fulfil it match nothing
    packed -- text columns held as ``keys.pack`` makes them: those of ``df`` are compared in
              that form, those of ``take`` get it before the join
    """
    pairs = _pairs(on)
    takes = _take(take)
    clash = sorted({dst for _, dst in takes} & set(df.columns))
    if clash:
        raise ValueError(f"lookup would duplicate columns {clash}; take them under other names")
    lk = [f"{prefix}{i}" for i in range(len(pairs))]

    d = dim.select(*[(pack(f"`{dc}`") if isinstance(le, str) and le in packed else F.col(f"`{dc}`")).alias(k) for (le, dc), k in zip(pairs, lk)],
                   *[F.col(f"`{src}`").alias(dst) for src, dst in takes])
    if dim_unique:
        if takes:
            first = F.min(F.struct(*[F.col(f"`{dst}`") for _, dst in takes])).alias("__row")
            d = d.groupBy(*lk).agg(first).select(*lk, "__row.*")
        else:
            d = d.select(*lk).distinct()
    # after the smallest values are found: packed texts have another order
    d = d.select(*lk, *[(pack(f"`{dst}`") if dst in packed else F.col(f"`{dst}`")).alias(dst) for _, dst in takes])

    if flag:
        d = d.withColumn(flag, F.lit(True))
    left_keys = [as_col(le, df).alias(f"{k}l") for (le, _), k in zip(pairs, lk)]
    left = df.select("*", *left_keys)
    cond = [F.col(f"{k}l") == F.col(k) for k in lk]
    if only is not None:
        cond.append(only)

    if salt and salt > 1:
        # the dimension is replicated to every bucket, so any bucket choice is
        # exact; mixing in the row position also spreads identical rows
        row_cols = [F.col(f"`{c}`") for c in df.columns]
        left = left.withColumn("__salt", F.pmod(F.xxhash64(*row_cols, F.monotonically_increasing_id()),
                                                F.lit(salt)))
        d = d.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
        cond.append(left["__salt"] == d["__salt"])
        out = left.join(d, cond, how).drop(left["__salt"]).drop(d["__salt"])
    else:
        out = left.join(d, cond, how)
    return out.drop(*lk, *[f"{k}l" for k in lk])


def chain(df: DataFrame, steps: Sequence[tuple[DataFrame, object, object]], **kw) -> DataFrame:
    """Apply lookups in order; later keys may use columns taken by earlier ones."""
    for dim, on, take in steps:
        df = lookup(df, dim, on, take, **kw)
    return df
