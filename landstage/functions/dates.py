"""Tolerant date parsing and timestamp text.

A landing job's ``to_date(from_unixtime(unix_timestamp(c, f), g), g)``
round trip is the same as parsing ``c`` with pattern ``f`` into a date;
here it is ``try_to_date`` (null on text that does not match, never an
exception).  Date and timestamp inputs are converted directly (the pattern
only applies to text).

For the two fixed-width patterns the loads use (``MM/dd/yyyy`` and
``yyyy-MM-dd``) text of exactly that shape takes a fast path: it is
rearranged to ISO order and cast with ``try_cast(... AS DATE)``, which
validates the calendar date the same way.  Everything else goes through the
pattern parser, so unusual text keeps the parser's exact behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landstage.functions.util import as_col

ISO = "yyyy-MM-dd"
MDY = "MM/dd/yyyy"

_FAST = {
    # pattern: (shape regex, SQL that builds ISO text from {s})
    ISO: (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "{s}"),
    MDY: (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
          "concat(substr({s}, 7, 4), '-', substr({s}, 1, 2), '-', substr({s}, 4, 2))"),
}


def parse_date_sql(c: str, fmt: str = ISO) -> str:
    """SQL text of :func:`parse_date` for column expression ``c``."""
    if fmt not in _FAST:
        return f"try_to_date({c}, '{fmt}')"
    shape, iso = _FAST[fmt]
    s = f"CAST({c} AS STRING)"
    return (f"CASE WHEN {s} RLIKE '{shape}' THEN try_cast({iso.format(s=s)} AS DATE) "
            f"ELSE try_to_date({c}, '{fmt}') END")


def parse_date(c, fmt: str = ISO) -> Column:
    col = as_col(c)
    if fmt not in _FAST:
        return F.try_to_date(col, fmt)
    shape, _ = _FAST[fmt]
    s = col.cast("string")
    if fmt == ISO:
        iso = s
    else:
        iso = F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 1, 2), F.lit("-"),
                       F.substring(s, 4, 2))
    return F.when(s.rlike(shape), iso.try_cast("date")).otherwise(F.try_to_date(col, fmt))


def format_ts(c, fmt: str = "MM/dd/yyyy hh:mm:ss") -> Column:
    """Timestamp rendered as text (``hh`` is the 01-12 clock, as written)."""
    return F.date_format(as_col(c), fmt)
