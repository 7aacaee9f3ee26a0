"""Record-level maps.

``map_columns`` is the fast path: column expressions evaluated in the JVM
inside whole-stage codegen.  ``map_records`` runs an opaque Python function
over Arrow batches with ``mapInArrow`` (one Python worker per task, batch
transfer); the function either takes one record dict at a time or, with
``vectorized=True``, a whole Arrow record batch.  Records are built from Arrow,
not pandas, so longs beyond 2**53 and nulls reach the function as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from landstage.functions.util import as_col


def map_columns(df: DataFrame, exprs: Mapping[str, object]) -> DataFrame:
    """Replace or add columns from expressions (``{'channel': 'channel + 10'}``)."""
    return df.withColumns({k: as_col(v) for k, v in exprs.items()})


def _pickle_package_by_value() -> None:
    """Send landstage code with the task instead of importing it on workers.

    Functions from this package used in a Python worker (record functions,
    helpers) are serialised by value, so executors need no copy of the
    package on their path (no --py-files step).
    """
    import landstage
    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(landstage)
    except ValueError:  # already registered
        pass


def map_records(df: DataFrame, fn: Callable, schema: StructType | str | None = None,
                vectorized: bool = False) -> DataFrame:
    """Map every record with ``fn``.

    ``fn`` takes and returns a dict (missing fields become null), or with
    ``vectorized=True`` a ``pyarrow.RecordBatch`` and returns a batch or table.
    """
    _pickle_package_by_value()
    out = df.schema if schema is None else _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            if vectorized:
                res = fn(batch)
                table = pa.Table.from_batches([res]) if isinstance(res, pa.RecordBatch) else res
                table = table.select(arrow.names).cast(arrow)
            else:
                table = pa.Table.from_pylist([fn(rec) for rec in batch.to_pylist()], schema=arrow)
            yield from table.to_batches()

    return df.mapInArrow(run, out)
