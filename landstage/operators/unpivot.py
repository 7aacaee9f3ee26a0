"""Unpivot numbered column slots (``x_1 .. x_n``) into rows.

Three layouts:

``positional``  one row per filled slot: the i-th values of every group
                stay together (slot-aligned).  One pass over the input plus
                one distinct.
``factored``    one row per key with the set of distinct values of each
                group over all of the key's rows and slots: the same facts
                as ``cross`` without their product.
``cross``       the legacy layout: every combination of a key's distinct
                values across the groups.  Row count per key is the product
                of the set sizes, so it is an explicit option; loads use
                ``positional``.

``cross`` is ``factored`` with its sets exploded, so both take one exchange by
key.  Only two kinds of keys are treated in another way, and nothing is
replicated for the others.  Both are found by a partial count of landing rows
per key, and a key only counts as heavy if it also holds more than one
``most``-th of all rows, so that at most ``most`` keys are broadcast:

heavy keys      keys with more than ``over`` landing rows.  Their distinct
                cells are dealt to buckets of about ``over`` values in every
                group that is wider than that, one row per bucket (or pair,
                ... of buckets where several groups are wide).  The buckets'
                products are disjoint and together the key's product.
large products  keys whose product has more than ``spread`` rows (a key with
                too few landing rows for that is not looked at): the widest
                set is cut into slices, which are dealt out before they are
                exploded, so several tasks make the product of one key.

A row of the factorised form holds the values of at most ``over`` landing rows,
or of one ``most``-th of all rows if that is more.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def slot_names(prefix: str, n: int, start: int = 1) -> list[str]:
    return [f"{prefix}{i}" for i in range(start, start + n)]


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def unpivot_positional(df: DataFrame, key, groups: Mapping[str, Sequence[str]],
                       drop_empty: bool = True, keep_position: bool = False,
                       position_name: str = "slot", distinct: bool = True) -> DataFrame:
    keys = _keys(key)
    names = list(groups)
    widths = {len(v) for v in groups.values()}
    if len(widths) != 1:
        raise ValueError("positional unpivot needs the same number of slots per group")
    n = widths.pop()
    slots = [F.struct(*[F.col(f"`{groups[g][i]}`").alias(g) for g in names]) for i in range(n)]
    out = df.select(*[F.col(f"`{k}`") for k in keys],
                    F.posexplode(F.array(*slots)).alias("__pos", "__slot"))
    if drop_empty:
        filled = [F.col(f"__slot.`{g}`").isNotNull() for g in names]
        out = out.where(reduce(lambda a, b: a | b, filled))
    cols = [F.col(f"`{k}`") for k in keys]
    if keep_position:
        cols.append((F.col("__pos") + 1).alias(position_name))
    cols += [F.col(f"__slot.`{g}`").alias(g) for g in names]
    out = out.select(*cols)
    return out.distinct() if distinct else out


def heavy_keys(df: DataFrame, key, over: int, most: int = 100_000) -> DataFrame:
    """Keys with more than ``over`` rows and more than one ``most``-th of all rows: at most ``most`` keys, and their rows ``n``."""
    keys = [F.col(f"`{k}`") for k in _keys(key)]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    share = counts.agg(F.sum("n") / most).scalar()
    return counts.where((F.col("n") > over) & (F.col("n") > share))


class _Slots:
    """The key and slot columns of a frame, each slot cast to the type of its group's first one."""

    def __init__(self, df: DataFrame, keys: list[str], groups: Mapping[str, Sequence[str]]):
        types = {f.name: f.dataType for f in df.schema.fields}
        self.keys, self.names = keys, list(groups)
        self.kind = [types[groups[g][0]] for g in groups]
        self.slots = [(i, F.col(f"`{c}`") if types[c] == self.kind[i] else F.col(f"`{c}`").cast(self.kind[i])) for i, g in enumerate(groups) for c in groups[g]]
        df = df.where(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys]))
        self.df = df.select(*[F.col(f"`{k}`") for k in keys], *[c.alias(f"__s{k}") for k, (_, c) in enumerate(self.slots)])

    def sets(self, df: DataFrame) -> DataFrame:
        """One row per key: its rows' slots are brought together, and each group's values made distinct."""
        rows = df.groupBy(*self.keys).agg(F.collect_list(F.struct(*[f"__s{k}" for k in range(len(self.slots))])).alias("__rows"))

        def distinct(i: int) -> Column:
            mine = [k for k, (j, _) in enumerate(self.slots) if j == i]
            return F.array_distinct(F.flatten(F.transform("__rows", lambda r: F.array(*[r[f"__s{k}"] for k in mine]))))

        return rows.select(*self.keys, *[distinct(i).alias(g) for i, g in enumerate(self.names)])

    def buckets(self, df: DataFrame, over: int) -> DataFrame:
        """A row per bucket of each key (of a bounded list): see the module's text on heavy keys."""
        groups = range(len(self.names))
        empty = [F.lit(None).cast(T.StructType([T.StructField("v", t)])) for t in self.kind]

        def cell(k: int, i: int) -> Column:
            # every group's value in a field of its own type; a set drops bare nulls, so values are wrapped
            value = F.struct(F.col(f"__s{k}").alias("v"))
            return F.struct(F.lit(i).alias("g"), *[(value if j == i else empty[j]).alias(f"v{j}") for j in groups])

        cells = df.select(*self.keys, F.explode(F.array(*[cell(k, i) for k, (i, _) in enumerate(self.slots)])).alias("__c")).select(*self.keys, "__c.*").distinct()
        width = cells.groupBy(*self.keys).agg(*[F.greatest(F.ceil(F.count_if(F.col("g") == i) / over), F.lit(1)).cast("int").alias(f"__w{i}") for i in groups])
        dealt = cells.join(F.broadcast(width), self.keys)
        for i in groups:
            own = F.array(F.pmod(F.xxhash64(f"v{i}"), F.col(f"__w{i}")).cast("int"))
            dealt = dealt.withColumn(f"__b{i}", F.explode(F.when(F.col("g") == i, own).otherwise(F.sequence(F.lit(0), F.col(f"__w{i}") - 1))))
        split = dealt.groupBy(*self.keys, *[f"__b{i}" for i in groups]).agg(*[F.collect_set(f"v{i}").alias(f"__s{i}") for i in groups])
        # a bucket that no value of some group fell into has no combinations
        split = split.where(reduce(lambda a, b: a & b, [F.size(f"__s{i}") > 0 for i in groups]))
        return split.select(*self.keys, *[F.transform(f"__s{i}", lambda x: x["v"]).alias(g) for i, g in enumerate(self.names)])

    def factored(self, df: DataFrame, over: int, most: int) -> DataFrame:
        heavy = F.broadcast(heavy_keys(df, self.keys, over, most).select(*self.keys))
        return self.sets(df.join(heavy, self.keys, "left_anti")).union(self.buckets(df.join(heavy, self.keys, "left_semi"), over))


def unpivot_factored(df: DataFrame, key, groups: Mapping[str, Sequence[str]], over: int = 100_000, most: int = 100_000) -> DataFrame:
    """One row per key with the distinct values (null included) of every group as an array.

    A heavy key has a row per bucket: in each of its rows every array has at most about
    ``over`` values, and each combination of the key's values is in exactly one row.
    Rows with a null in the key belong to no key.
    """
    slots = _Slots(df, _keys(key), groups)
    return slots.factored(slots.df, over, most)


def combinations(names: Sequence[str]) -> Column:
    """Number of combinations that a factored row stands for (its product is never formed)."""
    return reduce(lambda a, b: a * b, [F.size(f"`{g}`").cast("double") for g in names])


def unpivot_cross(df: DataFrame, key, groups: Mapping[str, Sequence[str]],
                  derive: Mapping[str, Mapping[str, object]] | None = None, over: int = 100_000,
                  spread: int = 1_000_000, most: int = 100_000) -> DataFrame:
    """Every combination of a key's distinct values across the groups.

    ``derive`` adds columns computed from the key and one group's value:
    ``{group: {name: Column}}``.  Groups with derived columns are exploded first,
    so those are evaluated on as few rows as possible.
    """
    keys = _keys(key)
    derive = derive or {}
    names = list(groups)
    slots = _Slots(df, keys, groups)
    # a key with at most ``few`` rows cannot have more than ``spread`` combinations
    few = int((spread / math.prod(len(groups[g]) for g in names)) ** (1 / len(names)))
    many = F.broadcast(heavy_keys(slots.df, keys, few, most).select(*keys))
    sets = slots.factored(slots.df.join(many, keys, "left_semi"), over, most)
    widest = F.array_max(F.array(*[F.struct(F.size(f"`{g}`").alias("n"), F.lit(i).alias("g")) for i, g in enumerate(names)]))
    cut = sets.withColumns({"__w": widest, "__n": F.greatest(F.ceil(combinations(names) / spread), F.lit(1))})
    cut = cut.withColumn("__size", F.greatest(F.floor(F.col("__w.n") / F.col("__n")).cast("int"), F.lit(1)))
    cut = cut.withColumn("__at", F.explode(F.sequence(F.lit(1), F.col("__w.n"), F.col("__size"))))
    cut = cut.select(*keys, "__at", *[F.when(F.col("__w.g") == i, F.slice(f"`{g}`", F.col("__at"), F.col("__size"))).otherwise(F.col(f"`{g}`")).alias(g) for i, g in enumerate(names)])
    out = slots.sets(slots.df.join(many, keys, "left_anti")).union(cut.repartition(*keys, "__at").drop("__at"))
    done: list[str] = []
    extra: list[str] = []
    left = sorted(names, key=lambda g: not derive.get(g))
    while left:
        g, *left = left
        out = out.select(*keys, *done, *extra, *left, F.explode(f"`{g}`").alias(g))
        done.append(g)
        if derive.get(g):
            out = out.withColumns(dict(derive[g]))
            extra += list(derive[g])
    return out.select(*keys, *groups, *extra)


def unpivot_slots(df: DataFrame, key, groups: Mapping[str, Sequence[str]],
                  mode: str = "positional", **kw) -> DataFrame:
    if mode == "positional":
        return unpivot_positional(df, key, groups, **kw)
    if mode == "cross":
        return unpivot_cross(df, key, groups, **kw)
    if mode == "factored":
        return unpivot_factored(df, key, groups, **kw)
    raise ValueError(f"unknown unpivot mode {mode!r}")


def explode_values(df: DataFrame, key, columns: Sequence[str], name: str,
                   distinct: bool = True) -> DataFrame:
    """``explode(array(c1..cn))`` per key: one row per slot value (nulls kept)."""
    keys = _keys(key)
    out = df.select(*[F.col(f"`{k}`") for k in keys],
                    F.explode(F.array(*[F.col(f"`{c}`") for c in columns])).alias(name))
    return out.distinct() if distinct else out
