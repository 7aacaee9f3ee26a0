"""Clean-and-nest plan: resolve a mixed-type id, drop rows whose id did not
resolve, strip a currency prefix from text amounts, then rename/cast/nest.

Fixed values: the mapping below is the provider-charges layout (source
names with spaces, dotted targets) used by the clean-and-nest job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.functions.text import chop_prefix
from landstage.operators.nesting import apply_mapping, q, resolve_choice

# ---- fixed values: provider-charges mapping (source, source type, target, target type)
PROVIDER_CHARGES_MAPPING = [
    ("drg definition", "string", "drg", "string"),
    ("provider id", "long", "provider.id", "long"),
    ("provider name", "string", "provider.name", "string"),
    ("provider city", "string", "provider.city", "string"),
    ("provider state", "string", "provider.state", "string"),
    ("provider zip code", "long", "provider.zip", "long"),
    ("hospital referral region description", "string", "rr", "string"),
    ("ACC", "string", "charges.covered", "double"),
    ("ATP", "string", "charges.total_pay", "double"),
    ("AMP", "string", "charges.medicare_pay", "double"),
]
PROVIDER_CHARGES_CHOP = {
    "ACC": "average covered charges",
    "ATP": "average total payments",
    "AMP": "average medicare payments",
}
PROVIDER_CHARGES_CHOICE = [("provider id", "cast:long")]


def clean_and_nest(df: DataFrame,
                   choice: Sequence[tuple[str, str]] = tuple(PROVIDER_CHARGES_CHOICE),
                   chop: Mapping[str, str] = PROVIDER_CHARGES_CHOP,
                   mapping: Sequence[tuple] = tuple(PROVIDER_CHARGES_MAPPING),
                   prefix_len: int = 1) -> DataFrame:
    # a value that resolves is never null before resolving: filtering the raw
    # column first lets the scan skip nulls (PushedFilters: IsNotNull)
    out = df
    for name, _ in choice:
        out = out.where(F.col(q(name)).isNotNull())
    out = resolve_choice(out, choice)
    for name, _ in choice:
        out = out.where(F.col(q(name)).isNotNull())
    out = out.withColumns({new: chop_prefix(F.col(q(src)), prefix_len) for new, src in chop.items()})
    return apply_mapping(out, mapping)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields to top-level columns named ``parent<sep>child``."""
    from pyspark.sql.types import StructType

    cols = []

    def walk(dtype, path, expr):
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name], expr.getField(f.name))
        else:
            cols.append(expr.alias(sep.join(path)))

    for f in df.schema.fields:
        walk(f.dataType, [f.name], F.col(q(f.name)))
    return df.select(*cols)
