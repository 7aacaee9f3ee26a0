"""Copies of file trees, byte by byte and file by file, on the executors.

The manifest of the source tree is dealt over tasks by size; a task streams each of
its files to a hidden name beside the target and then moves it into place, so a
file of the copy is either whole or not there.  A task that runs again (a lost
executor, speculation) writes the same bytes to another hidden name and moves
them again.  Nothing is parsed: names, folders, schemas and compression stay,
and unrelated tables below one root stay apart.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstage.operators.records import _pickle_package_by_value
from landstage.session import scratch_path
from landstage.sources.trees import Store, discover_files, open_store, reachable, resolved_root

#: Bytes that a copying task holds.
BLOCK = 8 << 20
#: Share of a task in the copy: files are dealt in about so many bytes.
TASK_BYTES = 1 << 30


def _copy_file(source, source_path: str, target, target_path: str) -> tuple[int, str]:
    """Streams one file; returns its length and sha256."""
    folder, _, name = target_path.rpartition("/")
    target.create_dir(folder, recursive=True)
    hidden = f"{folder}/._{uuid.uuid4().hex}-{name}"
    sha, n = hashlib.sha256(), 0
    with source.open_input_stream(source_path) as f, target.open_output_stream(hidden) as out:
        while block := f.read(BLOCK):
            out.write(block)
            sha.update(block)
            n += len(block)
    target.move(hidden, target_path)
    return n, sha.hexdigest()


def copy_files(files: DataFrame, src_root: str, dst_root: str, store: Store = open_store) -> DataFrame:
    """Copies the files of a manifest (relative, length); returns relative, length, sha256, copied.

    ``copied`` is the length found at the target.  The result is a written table: reading it
    again copies nothing.
    """
    _pickle_package_by_value()
    spark = files.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, a), (target, b) = store(src_root), store(dst_root)
        for batch in batches:
            for relative, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{b.rstrip('/')}/{relative}"
                n, sha = _copy_file(source, f"{a.rstrip('/')}/{relative}", target, path)
                if n != length:
                    raise OSError(f"{relative}: the manifest has {length} bytes, the file {n}")
                yield pa.RecordBatch.from_arrays([pa.array([relative]), pa.array([length]), pa.array([sha]), pa.array([target.get_file_info(path).size])], ["relative", "length", "sha256", "copied"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = files.agg(F.sum("length")).first()[0] or 0
    dealt = files.select("relative", "length").repartition(max(tasks, -(-total // TASK_BYTES)))
    done = dealt.mapInArrow(run, "relative string, length bigint, sha256 string, copied bigint")
    path = scratch_path(spark, "copied")
    done.write.parquet(path)
    return spark.read.schema(done.schema).parquet(path)


def copy_parquet_tree(spark: SparkSession, src_root: str, dst_root: str, contains: str = ".parquet", store: Store = open_store) -> DataFrame:
    """Copies every file below ``src_root`` whose relative path contains ``contains`` to the same place below ``dst_root``.

    Returns the manifest of the copy.  A file that is already there under the same name is
    replaced, other files of the target stay.  Both roots need a store that tasks can open.
    """
    src, dst = resolved_root(spark, src_root), resolved_root(spark, dst_root)
    for root in (src, dst):
        if not reachable(store, root):
            raise ValueError(f"tasks cannot open {root}; pass a store that does")
    return copy_files(discover_files(spark, src_root, contains, store), src, dst, store)
