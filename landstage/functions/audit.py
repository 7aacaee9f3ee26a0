"""Audit columns: source_table literal and load_dts stamp."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from landstage.functions.util import as_col


def now(at=None) -> Column:
    """``current_timestamp()`` or a pinned instant (tests, reruns)."""
    if at is None:
        return F.current_timestamp()
    if isinstance(at, (_dt.datetime, str)):
        return F.lit(at).cast("timestamp")
    return as_col(at)


def second_trunc(ts) -> Column:
    return F.date_trunc("second", as_col(ts))


def clock12(ts) -> Column:
    """The 12-hour round trip ``to_timestamp(date_format(ts, 'dd-MM-yyyy hh:mm:ss'))``.

    ``hh`` writes the hour on a 01-12 clock and reading it back without an
    am/pm marker takes the morning, so afternoon hours lose 12 hours
    (13:05 -> 01:05, 12:30 -> 00:30).  Computed on the wall clock of the
    session's time zone, as the text is, so a day with a clock change gives
    the same result as the text.
    """
    t = second_trunc(ts)
    wall = t.cast("timestamp_ntz") - F.expr("INTERVAL 12 HOURS")
    return F.when(F.hour(t) >= 12, wall.cast("timestamp")).otherwise(t)


def load_dts(at=None, mode: str = "exact") -> Column:
    """Load timestamp, whole seconds. ``mode='clock12'`` reproduces the legacy stamp."""
    ts = now(at)
    if mode == "exact":
        return second_trunc(ts)
    if mode == "clock12":
        return clock12(ts)
    if mode == "raw":
        return ts
    raise ValueError(f"unknown load_dts mode {mode!r}")


def audit_columns(source_table: str, at=None, mode: str = "exact") -> list[Column]:
    return [F.lit(source_table).alias("source_table"), load_dts(at, mode).alias("load_dts")]
