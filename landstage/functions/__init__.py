from landstage.functions.audit import audit_columns, clock12, load_dts, now, second_trunc
from landstage.functions.casts import to_decimal, to_double, to_int, to_long, tolerant_cast
from landstage.functions.dates import ISO, MDY, format_ts, parse_date
from landstage.functions.hashing import hash_diff, hash_key, hash_of
from landstage.functions.scalar import scalar_function
from landstage.functions.text import chop_prefix, to_utf8
from landstage.functions.util import as_col

__all__ = [
    "ISO", "MDY", "as_col", "audit_columns", "chop_prefix", "clock12",
    "format_ts", "hash_diff", "hash_key", "hash_of", "load_dts", "now", "parse_date",
    "scalar_function",    "second_trunc", "to_decimal", "to_double", "to_int", "to_long", "to_utf8", "tolerant_cast",
]
