from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORDS = re.compile(r"[A-Za-z_]\w*(\s+[A-Za-z_]\w*)+")
# SQL words that make a run of words an expression
_SQL_WORDS = {"and", "or", "not", "is", "null", "in", "like", "rlike", "between", "case", "when", "then", "else", "end",
              "div", "as", "interval", "distinct", "exists", "true", "false", "current_date", "current_timestamp"}


def as_col(c, df: DataFrame | None = None) -> Column:
    """Column from a Column, a column name or a SQL expression string.

    A string that names a column of ``df`` is that column, whatever characters
    it has.  Otherwise bare (possibly back-quoted) identifiers are column
    references and anything else is parsed as a SQL expression; a run of bare
    words without any SQL word would silently be read as an alias and is refused.
    """
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        if df is not None and c in df.columns:
            return F.col("`" + c.replace("`", "``") + "`")
        s = c.strip()
        if s.startswith("`") and s.endswith("`") and s.count("`") == 2:
            return F.col(s)
        if s.replace("_", "a").replace(".", "a").isalnum() and not s[0].isdigit():
            return F.col(s)
        if _WORDS.fullmatch(s) and not _SQL_WORDS & set(s.lower().split()):
            raise ValueError(f"{s!r} is neither a column nor an expression; put back-quotes around a name with spaces")
        return F.expr(s)
    return F.lit(c)
