from landstage.operators.dedupe import dedupe, dedupe_repeated, repeated_hashes
from landstage.operators.keys import id_from_hash, with_surrogate_id
from landstage.operators.lookup import chain, lookup
from landstage.operators.nesting import (apply_mapping, explode_field, relationalize,
                                         resolve_choice, row_id)
from landstage.operators.records import map_columns, map_records
from landstage.operators.unpivot import (combinations, explode_values, heavy_keys, slot_names, unpivot_cross,
                                         unpivot_factored, unpivot_positional, unpivot_slots)

__all__ = [
    "apply_mapping", "chain", "combinations", "dedupe", "dedupe_repeated", "explode_field", "explode_values",
    "heavy_keys", "id_from_hash", "lookup", "map_columns", "map_records", "relationalize", "repeated_hashes", "resolve_choice",
    "row_id", "slot_names", "unpivot_cross", "unpivot_factored", "unpivot_positional", "unpivot_slots",
    "with_surrogate_id",
]
