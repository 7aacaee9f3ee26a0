"""Declarative load specs and the runner that turns one into a DataFrame plan.

A load is: landing frame -> optional dedupe -> lookups (inner, in order)
-> optional slot unpivot -> one projection with the business columns, the
two hashes over the *raw* landing columns, and the audit stamp.

Expressions are SQL strings evaluated against the frame at that step, so a
spec is plain data and needs no Spark session to define.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from landstage.functions.audit import audit_columns
from landstage.functions.dates import parse_date_sql
from landstage.functions.hashing import hash_of
from landstage.functions.util import as_col
from landstage.operators.dedupe import dedupe
from landstage.operators.keys import unpack
from landstage.operators.lookup import lookup
from landstage.operators.unpivot import unpivot_cross, unpivot_slots


# SQL builders for the tolerant conversions (same semantics as landstage.functions)
def int_of(c: str) -> str:
    return f"try_cast(try_cast({c} AS DECIMAL(38,18)) AS INT)"


def dec_of(c: str, p: int = 7, s: int = 2) -> str:
    return f"try_cast({c} AS DECIMAL({p},{s}))"


def date_of(c: str, fmt: str) -> str:
    return parse_date_sql(c, fmt)


@dataclass(frozen=True)
class Lookup:
    dim: str                                   # input name of the dimension frame
    on: tuple[tuple[str, str], ...]            # (left expression, dimension column)
    take: tuple[tuple[str, str], ...]          # (dimension column, output name)
    unique: bool = False                       # one dim row per key (no fan-out)
    salt: int = 0                              # spread a hot landing key over so many buckets


@dataclass(frozen=True)
class Unpivot:
    key: str
    groups: tuple[tuple[str, tuple[str, ...]], ...]
    mode: str = "positional"
    spread: int = 1_000_000                    # cross mode: most combinations of a key made by one task


@dataclass(frozen=True)
class LoadSpec:
    name: str
    source: str                                # input name of the landing frame
    target: str                                # staging table written to
    source_table: str                          # literal of the source_table column
    select: tuple[tuple[str, str], ...]        # (expression, output name)
    hash_key: tuple[str, ...]
    hash_diff: tuple[str, ...]
    dedupe: tuple[str, ...] | None = None      # key expressions; None = keep all rows
    dedupe_names: tuple[str, ...] | None = None  # names for derived dedupe keys
    lookups: tuple[Lookup, ...] = ()
    unpivot: Unpivot | None = None

    def needs(self) -> list[str]:
        return [self.source] + [lk.dim for lk in self.lookups]


def dedupe_columns(spec: LoadSpec):
    names = spec.dedupe_names or tuple([None] * len(spec.dedupe))
    cols = []
    for e, n in zip(spec.dedupe, names):
        c = as_col(e)
        cols.append(c.alias(n) if n else c)
    return cols


MISSING = "__missing"


_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _packed(spec: LoadSpec, inputs: Mapping[str, DataFrame], narrow: bool | Collection[str]) -> Iterator[tuple[Lookup, list[str]]]:
    """Every lookup with the taken texts that are in packed form in it (none if not ``narrow``).

    A taken text is packed if later lookups use it only as a whole key that is a text too, and
    only in dimensions of ``narrow`` if that names some.
    """
    def text(lk: Lookup, column: str) -> bool:
        return inputs[lk.dim].schema[column].dataType == StringType()

    def whole(lk: Lookup, name: str) -> bool:
        used = [(left, column) for left, column in lk.on if name in _IDENT.findall(left)]
        return not used or (narrow is True or lk.dim in narrow) and all(left == name and text(lk, column) for left, column in used)

    held: list[str] = []
    for i, lk in enumerate(spec.lookups):
        if narrow is not False:
            held += [name for column, name in lk.take if text(lk, column) and all(whole(x, name) for x in spec.lookups[i + 1:])]
        yield lk, list(held)


def _unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({name: unpack(f"`{name}`") for name in names}) if names else df


def flagged(spec: LoadSpec, inputs: Mapping[str, DataFrame], once: bool = False, narrow: bool | Collection[str] = False, repeats: bool = False) -> DataFrame:
    """The landing rows after all lookups, none dropped: ``__missing`` names the first dimension without a match.

    One pass: each lookup is one left join, whose flag says whether it found a row; a row that
    has missed matches nothing more.  ``once``: one dimension row per key in every lookup,
    so that a landing row occurs once whatever it meets.  ``narrow``, ``repeats``: as in ``run_load``.
    """
    df, packed = _flagged(spec, inputs, once, narrow, repeats)
    return _unpacked(df, packed)


def _flagged(spec: LoadSpec, inputs: Mapping[str, DataFrame], once: bool, narrow: bool | Collection[str], repeats: bool) -> tuple[DataFrame, list[str]]:
    df = _landing(spec, inputs, repeats)
    df = df.withColumn(MISSING, F.lit(None).cast("string"))
    packed: list[str] = []
    for lk, packed in _packed(spec, inputs, narrow):
        df = lookup(df, inputs[lk.dim], list(lk.on), list(lk.take), how="left", dim_unique=once or lk.unique, salt=lk.salt,
                    flag="__hit", only=F.col(MISSING).isNull(), packed=packed)
        df = df.withColumn(MISSING, F.coalesce(MISSING, F.when(F.col("__hit").isNull(), F.lit(lk.dim)))).drop("__hit")
    return df, packed


def unmatched(spec: LoadSpec, inputs: Mapping[str, DataFrame], narrow: bool = False) -> DataFrame:
    """Landing rows that the load's inner lookups drop, with the first lookup that misses.

    One row per (deduplicated) landing row: its columns and ``missing``, the name of
    the dimension without a match.  Rows that pass all lookups are absent.  ``narrow``: as in ``run_load``.
    """
    if not spec.lookups:
        raise ValueError(f"{spec.name} has no lookups")
    landing = inputs[spec.source]
    landing = (landing if spec.dedupe is None else landing.select(*dedupe_columns(spec))).columns
    return flagged(spec, inputs, once=True, narrow=narrow).where(F.col(MISSING).isNotNull()).select(*[F.col(f"`{c}`") for c in landing], F.col(MISSING).alias("missing"))


def lookup_counts(spec: LoadSpec) -> list:
    """Aggregates over a flagged load: rows that passed all lookups, and those that each lookup lost."""
    lost = [F.count_if(F.col(MISSING) == lk.dim).alias(f"lost_{lk.dim}") for lk in spec.lookups]
    return [F.count_if(F.col(MISSING).isNull()).alias("matched"), *lost]


def _before_fan_out(spec: LoadSpec, groups: dict[str, list[str]]):
    """Split the select list of a cross-unpivot load into expressions that
    depend on the key or on one group only (evaluated before the other groups
    are combined) and the rest; likewise a hash_key over key columns only."""
    key = spec.unpivot.key
    names = set(groups) | {key}
    derive: dict[str, dict] = {}
    select = []
    for i, (expr, name) in enumerate(spec.select):
        refs = {t for t in _IDENT.findall(expr) if t in names}
        owner = [g for g in groups if refs and refs <= {key, g} and g in refs]
        if owner and expr.strip() != owner[0]:
            col = f"__pre{i}"
            derive.setdefault(owner[0], {})[col] = as_col(expr)
            select.append((col, name))
        else:
            select.append((expr, name))
    key_hash = None
    if spec.hash_key and set(spec.hash_key) <= {key}:
        first = next(iter(groups))
        key_hash = "__key_hash"
        derive.setdefault(first, {})[key_hash] = hash_of(*spec.hash_key)
    return select, derive, key_hash


def _landing(spec: LoadSpec, inputs: Mapping[str, DataFrame], repeats: bool) -> DataFrame:
    df = inputs[spec.source]
    if spec.dedupe is None:
        return df
    return df.select(*dedupe_columns(spec)) if repeats else dedupe(df, dedupe_columns(spec))


def _dealt(df: DataFrame, spec: LoadSpec, n: int, keys: Sequence[str], packed: list[str]) -> DataFrame:
    """The rows with plain texts, dealt by staging columns; packed texts are moved as they are, unless a key is made of one."""
    made = {name: expr for expr, name in spec.select}
    first = [name for name in packed if any(name in _IDENT.findall(made[k]) and made[k] != name for k in keys)]
    later = [name for name in packed if name not in first]
    dealt = _unpacked(df, first).repartition(n, *[unpack(f"`{made[k]}`") if made[k] in later else as_col(made[k]) for k in keys])
    return _unpacked(dealt, later)


def run_load(spec: LoadSpec, inputs: Mapping[str, DataFrame], at=None,
             stamp: str | None = "exact", around_unpivot=None, counts: Observation | None = None, narrow: bool | Collection[str] = False,
             repeats: bool = False, deal: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """Build the staging frame of ``spec`` from named input frames (no action).

    ``around_unpivot(df, unpivot)``, if given, returns the frame after the unpivot in its place.
    ``counts``, if given, holds ``matched`` and ``lost_<dimension>`` after the frame's first
    action: the rows that the lookups passed and that each of them lost, counted as they go by.
    ``narrow``: the texts that lookups take are moved in packed form, which is half as wide for ids
    (a dimension that is bucketed by such a key is then shuffled; if ``narrow`` names dimensions, only their
    keys are packed).  ``repeats``: equal landing rows stay, for a reader that makes the rows distinct
    itself, as a lookup of unique keys does.  ``deal=(n, keys)``: the rows are dealt to ``n`` partitions by the
    staging columns ``keys`` before the hashes are made of them, which are wider than what they are made of.
    """
    missing = [n for n in spec.needs() if n not in inputs]
    if missing:
        raise KeyError(f"{spec.name}: missing inputs {missing}")
    if counts is not None:
        df, packed = _flagged(spec, inputs, False, narrow, repeats)
        df = df.observe(counts, *lookup_counts(spec)).where(F.col(MISSING).isNull()).drop(MISSING)
    else:
        df = _landing(spec, inputs, repeats)
        packed = []
        for lk, packed in _packed(spec, inputs, narrow):
            df = lookup(df, inputs[lk.dim], list(lk.on), list(lk.take), dim_unique=lk.unique, salt=lk.salt, packed=packed)
    if deal:
        if spec.unpivot is not None:
            raise ValueError(f"{spec.name} makes its rows after the lookups; deal them when they are written")
        df = _dealt(df, spec, *deal, packed)
    else:
        df = _unpacked(df, packed)
    select = list(spec.select)
    key_hash = None
    if spec.unpivot is not None:
        u = spec.unpivot
        groups = {g: list(cols) for g, cols in u.groups}
        if u.mode == "cross":
            select, derive, key_hash = _before_fan_out(spec, groups)

            def unpivot(x: DataFrame) -> DataFrame:
                return unpivot_cross(x, u.key, groups, derive=derive, spread=u.spread)
        else:
            def unpivot(x: DataFrame) -> DataFrame:
                return unpivot_slots(x, u.key, groups, mode=u.mode)
        df = around_unpivot(df, unpivot) if around_unpivot else unpivot(df)
    cols = [as_col(e).alias(n) for e, n in select]
    same = tuple(spec.hash_key) == tuple(spec.hash_diff)
    cols.append((F.col(key_hash) if key_hash else hash_of(*spec.hash_key)).alias("hash_key"))
    if not same:
        cols.append(hash_of(*spec.hash_diff).alias("hash_diff"))
    if stamp is None:
        cols.append(F.lit(spec.source_table).alias("source_table"))
    else:
        cols.extend(audit_columns(spec.source_table, at=at, mode=stamp))
    out = df.select(*cols)
    if same:
        # one sha1 per row; the optimizer does not inline an expensive
        # expression into two references
        names = [n for _, n in spec.select]
        out = out.select(*[F.col(f"`{n}`") for n in names], "hash_key",
                         F.col("hash_key").alias("hash_diff"),
                         *[c for c in out.columns if c not in names and c != "hash_key"])
    return out
