"""Row hashes used as staging identity (hash_key) and change detection (hash_diff).

The staging format is ``hex(sha1(concat(utf8(cast(c as string)) ...)))``:
80 upper-case hex characters (the hex of the 40-character sha1 text),
parts joined without separator, and null as soon as any part is null.
Options allow a separator and a null replacement for new tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landstage.functions.util import as_col


def _part(c, null_as: str | None) -> Column:
    # Spark strings are UTF-8 already: cast(... as binary) yields the same
    # bytes as encode(..., 'UTF-8') without decoding and re-encoding.
    text = as_col(c).cast("string")
    if null_as is not None:
        text = F.coalesce(text, F.lit(null_as))
    return text.cast("binary")


def hash_of(*cols, sep: str | None = None, null_as: str | None = None) -> Column:
    """Composite hash of columns (names, SQL expressions or Columns)."""
    if len(cols) == 1 and isinstance(cols[0], (list, tuple)):
        cols = tuple(cols[0])
    if not cols:
        raise ValueError("hash_of needs at least one column")
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if sep is not None and i:
            parts.append(F.lit(sep).cast("binary"))
        parts.append(_part(c, null_as))
    return F.hex(F.sha1(F.concat(*parts)))


def hash_key(*cols, **kw) -> Column:
    """Identity hash over the business key columns."""
    return hash_of(*cols, **kw).alias("hash_key")


def hash_diff(*cols, **kw) -> Column:
    """Change hash over the tracked attribute columns."""
    return hash_of(*cols, **kw).alias("hash_diff")
