"""Nesting and flattening: explode, declarative mapping, choice resolution,
relationalize (nested frame -> root + child frames)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from landstage.functions.casts import tolerant_cast
from landstage.functions.util import as_col
from landstage.session import scratch_path


def q(name: str) -> str:
    """Back-quote a column name (spaces, dots) for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


# --------------------------------------------------------------------- explode
def explode_field(df: DataFrame, column, alias: str, keep: Sequence[str] = (),
                  outer: bool = False) -> DataFrame:
    """One row per array element (null elements kept; null/empty arrays drop
    the row unless ``outer``)."""
    fn = F.explode_outer if outer else F.explode
    return df.select(*[F.col(q(k)) for k in keep], fn(as_col(column)).alias(alias))


# ----------------------------------------------------------------- apply_mapping
def _insert(tree: dict, path: list[str], leaf: Column) -> None:
    head = path[0]
    if len(path) == 1:
        if head in tree:
            raise ValueError(f"target {head!r} mapped twice")
        tree[head] = leaf
        return
    node = tree.setdefault(head, {})
    if not isinstance(node, dict):
        raise ValueError(f"target {head!r} is both a leaf and a struct")
    _insert(node, path[1:], leaf)


def _build(tree: dict) -> list[Column]:
    out = []
    for name, node in tree.items():
        if isinstance(node, dict):
            out.append(F.struct(*_build(node)).alias(name))
        else:
            out.append(node.alias(name))
    return out


def apply_mapping(df: DataFrame, mappings: Sequence[tuple]) -> DataFrame:
    """Rename, cast and nest in one ``select``.

    mappings -- (source, source_type, target, target_type) tuples.  Dotted
    targets build structs (``provider.id``); a dotted source that is not a
    top-level column reads a struct field, so a mapping can also flatten;
    casts are tolerant; source columns not listed are dropped.
    """
    tree: dict = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for m in mappings:
        src, _src_type, target, target_type = m
        if src in types:                       # a top-level column (may contain spaces or dots)
            source = F.col(q(src))
        else:                                  # a dotted path into a struct
            source = F.col(".".join(q(part) for part in src.split(".")))
        leaf = tolerant_cast(source, target_type, types.get(src))
        _insert(tree, target.split("."), leaf)
    return df.select(*_build(tree))


# ---------------------------------------------------------------- resolve_choice
def resolve_choice(df: DataFrame, specs: Sequence[tuple[str, str]]) -> DataFrame:
    """Resolve mixed-type columns: ``(column, 'cast:<type>')`` -> tolerant cast."""
    repl = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, action in specs:
        kind, _, arg = action.partition(":")
        if kind != "cast":
            raise ValueError(f"unsupported resolve action {action!r}")
        repl[name] = tolerant_cast(F.col(q(name)), arg, types.get(name))
    return df.withColumns(repl)


# ----------------------------------------------------------------- relationalize
def row_id(*cols) -> Column:
    """Stable text id of a key: the sha1 digest of its parts.

    Every part is written as its length and text, or ``-`` for null, so
    (null, 'a') and ('a', null) differ and no part can run into the next.
    """
    parts = [as_col(c).cast("string") for c in cols]
    text = F.concat(*[F.when(p.isNull(), F.lit("-")).otherwise(F.concat(F.length(p).cast("string"), F.lit(":"), p)) for p in parts])
    return F.sha1(F.encode(text, "UTF-8"))


def _flatten(dtype: DataType, expr: Column, path: str, sep: str,
             scalars: list, arrays: list) -> None:
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            _flatten(f.dataType, expr.getField(f.name), f"{path}{sep}{f.name}" if path else f.name,
                     sep, scalars, arrays)
    elif isinstance(dtype, ArrayType):
        arrays.append((path, expr, dtype.elementType))
    else:
        scalars.append((path, expr))


def relationalize(df: DataFrame, name: str = "root", key: Sequence[str] | None = None,
                  sep: str = ".", staged: bool | None = None) -> dict[str, DataFrame]:
    """Flatten a nested frame into a collection of flat frames.

    Root frame: structs become dotted columns; every array column is replaced
    by the row's id (null when the array is null).  Each array becomes a child
    frame ``{name}_{path}`` with ``id`` (the parent's id), ``index`` (0-based)
    and the element flattened under ``{path}.val``.  Arrays nested in elements
    recurse, keyed by (parent id, index).  Ids come from ``key`` columns
    (default: all columns, arrays included), so they are stable across reruns
    and executor retries.  Rows that are equal in the key share an id; without
    a key these are true duplicates, whose children are equal too.

    ``staged`` (default: without a key) writes the rows with their ids once to the shared
    scratch folder: the input is read and every id computed in that one pass, and each
    frame then scans only its own columns and the id, never the other arrays.  With a
    key nothing is written, and a frame's scan has its own columns and the key.
    """
    frames: dict[str, DataFrame] = {}
    if staged or (staged is None and not key):
        rows = df.withColumn("__rid", _own_id(df, key, sep))
        path = scratch_path(df.sparkSession, "relationalize")
        rows.write.parquet(path)
        _relationalize(df.sparkSession.read.schema(rows.schema).parquet(path), name, sep, frames, F.col("__rid"))
    else:
        _relationalize(df, name, sep, frames, _own_id(df, key, sep))
    return frames


def _fields(df: DataFrame, sep: str) -> tuple[list, list]:
    scalars: list = []
    arrays: list = []
    for f in df.schema.fields:
        if f.name != "__rid":
            _flatten(f.dataType, F.col(q(f.name)), f.name, sep, scalars, arrays)
    return scalars, arrays


def _own_id(df: DataFrame, key: Sequence[str] | None, sep: str) -> Column:
    if key:
        return row_id(*[F.col(k) for k in key])
    scalars, arrays = _fields(df, sep)
    return row_id(*[e for _, e in scalars], *[F.to_json(e) for _, e, _ in arrays])


def _relationalize(df: DataFrame, name: str, sep: str, frames: dict, id_expr: Column) -> None:
    scalars, arrays = _fields(df, sep)
    base = df.withColumn("__rid", id_expr)

    cols = [e.alias(p) for p, e in scalars]
    cols += [F.when(e.isNotNull(), F.col("__rid")).alias(p) for p, e, _ in arrays]
    frames[name] = base.select(*cols)

    for path, expr, etype in arrays:
        child_name = f"{name}_{path.replace(sep, '_')}"
        child = base.select(F.col("__rid").alias("id"), F.posexplode(expr).alias("index", "__el"))
        val = f"{path}{sep}val"
        c_scalars: list = []
        c_arrays: list = []
        _flatten(etype, F.col("__el"), val, sep, c_scalars, c_arrays)
        c_cols = [F.col("id"), F.col("index")] + [e.alias(p) for p, e in c_scalars]
        if not c_arrays:
            frames[child_name] = child.select(*c_cols)
            continue
        # element arrays recurse with the element's own id
        eid = row_id(F.col("id"), F.col("index"))
        inner = child.select(F.col("id"), F.col("index"), F.col("__el").alias(val))
        sub: dict[str, DataFrame] = {}
        _relationalize(inner, child_name, sep, sub, eid)
        frames.update(sub)
