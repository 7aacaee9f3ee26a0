"""Bookmarked (incremental) loads with Structured Streaming.

A landing job that runs repeatedly should only load the landing files that
arrived since its last run (the job-bookmark idea).  Here the landing folder
is a streaming file source, the checkpoint folder (in the shared folder)
records which files were processed, and ``trigger(availableNow=True)``
processes everything new and stops, so the job can be scheduled like a
batch job.  Each micro-batch runs the same load spec as the batch path,
with static dimension frames for lookups, and writes to the staging
output.  After a lost executor or a failed run, the next run resumes from
the checkpoint.  A micro-batch whose output was committed but whose
checkpoint entry was not is run again; each batch therefore overwrites its
own ``batch_id=<n>`` folder instead of appending, so a rerun replaces its
rows rather than duplicating them.

A load that removes duplicates does so over all batches: the distinct keys of
each batch are kept beside the checkpoint, and a batch only loads keys that no
earlier batch had.  The distinct rows that an unpivot makes are kept and compared
in the same way; for a cross unpivot also each key's slots, so that its values of all
batches are combined.  So the rows do not depend on how files arrive or how many
of them a batch takes.  A checkpoint without these folders (of a load that kept none)
cannot be continued: the next batch fails, and the load has to start anew.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from landstage.operators.dedupe import dedupe
from landstage.plans.spec import LoadSpec, dedupe_columns, run_load


def run_incremental(spark: SparkSession, spec: LoadSpec, landing_path: str, target_path: str,
                    checkpoint: str, dims: Mapping[str, DataFrame] | None = None,
                    fmt: str = "parquet", at=None, stamp: str | None = "exact",
                    max_files_per_batch: int | None = None, target_format: str = "parquet") -> int:
    """Load the landing files not seen before; returns the number of micro-batches run.

    Reading ``target_path`` back gives every batch's rows plus a ``batch_id`` column.
    """
    schema = spark.read.format(fmt).load(landing_path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    landing = reader.load(landing_path)
    static = dict(dims or {})
    batches: list[int] = []

    beside = checkpoint.rstrip("/")

    def up_to(schema: StructType, root: str, batch_id: int) -> DataFrame:
        """What the batches up to ``batch_id`` wrote below ``root``."""
        rows = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).option("basePath", root).parquet(root)
        return rows.where(F.col("batch_id") <= batch_id).drop("batch_id")

    def unseen(rows: DataFrame, names: list[str], root: str, batch_id: int) -> DataFrame:
        """The rows whose ``names`` no earlier batch had, written below ``root`` for later batches."""
        path = f"{root}/batch_id={batch_id}"
        if batch_id:
            seen = up_to(rows.select(*[F.col(f"`{c}`") for c in names]).schema, root, batch_id - 1)
            seen = seen.select(*[F.col(f"`{c}`").alias(f"__seen_{c}") for c in names])
            same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__seen_{c}`")) for c in names])
            rows = rows.join(seen, same, "left_anti")
        rows.write.mode("overwrite").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        def around_unpivot(df: DataFrame, unpivot) -> DataFrame:
            u = spec.unpivot
            if u.mode == "cross":
                # a key's values of all batches so far are combined
                root = f"{beside}-slots"
                slots = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([u.key, *(c for _, cols in u.groups for c in cols)])]).distinct()
                slots.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
                own = spark.read.schema(slots.schema).parquet(f"{root}/batch_id={batch_id}").select(F.col(f"`{u.key}`"))
                df = up_to(slots.schema, root, batch_id).join(own.distinct(), u.key, "left_semi")
            return unseen(unpivot(df), [u.key, *(g for g, _ in u.groups)], f"{beside}-rows", batch_id)

        inputs = dict(static)
        once = spec
        if spec.dedupe is not None:
            keys = dedupe(batch, dedupe_columns(spec))
            batch, once = unseen(keys, keys.columns, f"{beside}-keys", batch_id), dataclasses.replace(spec, dedupe=None)
        inputs[spec.source] = batch
        out = run_load(once, inputs, at=at, stamp=stamp, around_unpivot=around_unpivot)
        out.write.mode("overwrite").format(target_format).save(f"{target_path.rstrip('/')}/batch_id={batch_id}")
        batches.append(batch_id)

    query = (landing.writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return len(batches)
