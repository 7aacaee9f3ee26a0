"""Trees of files: listed on the executors into a manifest, read by predicate.

``list_tree`` goes down a tree level by level: the folders of a level are rows of
a DataFrame, tasks list them and give files and folders back, and every level is
written to the shared scratch folder.  The driver knows the number of levels and
whether a level has folders left, never a path.  The manifest is a table that
later steps filter, join and deal out like any other.

Tasks reach files through a *store*: a function from a URI to a pyarrow
filesystem and a path in it (``open_store`` knows local and shared folders, S3,
GCS and HDFS).  A root that no store opens (a scheme that only Spark has) is
listed by Spark's own file index, with the same columns and the same rule (that index
leaves out files without a byte).

Files and folders whose names start with ``_`` or ``.`` are no data (markers,
checksums, unfinished work) and are left out, as Spark's readers do.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landstage.operators.records import _pickle_package_by_value
from landstage.session import scratch_path

Store = Callable[[str], tuple[pafs.FileSystem, str]]
#: Entries that a listing hands on at once.
BATCH = 10_000


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a URI as Hadoop spells it (not percent-encoded)."""
    scheme, found, path = uri.partition(":")
    if not found or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (path if found else uri).lstrip("/")
    return pafs.FileSystem.from_uri(f"{scheme}:{quote(path, safe='/:@')}")


def reachable(store: Store, root: str) -> bool:
    """Whether a store opens the root (decided by its scheme, before any job)."""
    try:
        store(root)
    except (OSError, ValueError):
        return False
    return True


def resolved_root(spark: SparkSession, root: str) -> str:
    """``root`` as the file index spells it: with scheme, without a trailing slash."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(path).toString().rstrip("/")


def plain_path(path: Column) -> Column:
    """A file path as the file index spells it, also when it comes percent-encoded from the metadata column."""
    decoded = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.regexp_replace(decoded, "^([a-z]+):/+", "$1:/")


def _root_text(root: str) -> str:
    scheme, _, rest = root.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}/"


def relative_path(path: Column, root: str) -> Column:
    """The part of ``path`` below ``root`` (resolved); an error if the path lies elsewhere."""
    start = _root_text(root)
    return F.when(F.startswith(path, F.lit(start)), F.substr(path, F.lit(len(start) + 1))) \
        .otherwise(F.raise_error(F.concat(F.lit(f"not below {start}: "), path)))


def _is_data(name: str) -> bool:
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def list_level(folders: DataFrame, root: str, store: Store) -> DataFrame:
    """Entries of the folders (a column ``relative``): relative, is_folder, length, modified (microseconds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base.rstrip('/')}/{folder}".rstrip("/") or "/"))
                found = [x for x in found if _is_data(x.base_name)]
                for at in range(0, len(found), BATCH):
                    some = found[at:at + BATCH]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{folder}/{x.base_name}" if folder else x.base_name for x in some]), pa.array([x.type == pafs.FileType.Directory for x in some]),
                         pa.array([x.size for x in some], pa.int64()), pa.array([x.mtime_ns // 1000 if x.mtime_ns is not None else None for x in some], pa.int64())],
                        ["relative", "is_folder", "length", "modified"])

    return folders.mapInArrow(run, "relative string, is_folder boolean, length bigint, modified bigint")


def list_tree(spark: SparkSession, root: str, store: Store = open_store) -> DataFrame:
    """Manifest of every file below ``root``: path, relative, folder, length, modificationTime.

    One job per level of the tree, its folders dealt over all tasks.  A folder is listed by
    one task.  The manifest is a written table: it does not change when it is read again.
    """
    _pickle_package_by_value()
    where = resolved_root(spark, root)
    folders, levels = spark.createDataFrame([("",)], "relative string"), []
    while True:
        path = scratch_path(spark, "listing")
        dealt = folders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if levels else folders
        found = list_level(dealt, where, store)
        found.write.parquet(path)
        found = spark.read.schema(found.schema).parquet(path)
        levels.append(found.where("not is_folder"))
        folders = found.where("is_folder").select("relative")
        if folders.isEmpty():
            break
    files = reduce(DataFrame.union, levels)
    folder = F.regexp_replace("relative", "/?[^/]*$", "")
    return files.select(F.concat(F.lit(_root_text(where)), F.col("relative")).alias("path"), "relative", folder.alias("folder"),
                        "length", F.timestamp_micros("modified").alias("modificationTime"))


def discover_files(spark: SparkSession, root: str, contains: str = ".parquet", store: Store = open_store) -> DataFrame:
    """Files under ``root`` (recursive) whose relative path contains ``contains``.

    Columns: path, relative (path below root), length, modificationTime.  No file is
    opened.  Every path occurs once.
    """
    if reachable(store, resolved_root(spark, root)):
        files = list_tree(spark, root, store)
    else:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
                 .select(F.regexp_replace("path", "^([a-z]+):/+", "$1:/").alias("path"), "length", "modificationTime"))
        files = files.withColumn("relative", relative_path(F.col("path"), resolved_root(spark, root)))
    return files.where(F.col("relative").contains(contains)).select("path", "relative", "length", "modificationTime")


def file_schemas(files: DataFrame, root: str, store: Store = open_store) -> DataFrame:
    """The different schemas of Parquet files (JSON), with the first file that has each; footers are read by the tasks."""
    _pickle_package_by_value()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        fs, base = store(root)
        for batch in batches:
            schemas = []
            for relative in batch.column(0).to_pylist():
                with fs.open_input_file(f"{base.rstrip('/')}/{relative}") as f:
                    schema = pq.read_schema(f)
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                schemas.append(own.decode() if own else from_arrow_schema(schema, prefer_timestamp_ntz=True).json())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(schemas, pa.string())], ["relative", "schema"])

    spark = files.sparkSession
    dealt = files.select("relative").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(run, "relative string, schema string").groupBy("schema").agg(F.min("relative").alias("first"), F.count(F.lit(1)).alias("n_files"))


def merged_schema(schemas: DataFrame) -> StructType:
    """Union of the schemas in the order of their first files; one name has one type."""
    out: dict = {}
    for row in schemas.orderBy("first").select("schema").collect():        # as many rows as there are different schemas
        for field in StructType.fromJson(json.loads(row["schema"])).fields:
            if out.setdefault(field.name, field).dataType != field.dataType:
                raise ValueError(f"{field.name} is {out[field.name].dataType.simpleString()} in one file and {field.dataType.simpleString()} in another")
    return StructType(list(out.values()))


def read_tree(spark: SparkSession, root: str, fmt: str = "parquet", contains: str = ".parquet",
              merge_schema: bool = False, store: Store = open_store, **options) -> DataFrame:
    """All files that ``discover_files`` finds as one scan, each row tagged with
    its file: ``source_file`` (full path) and ``relative`` (path below root).

    The files are picked by a predicate on the path, which Spark applies to its file
    index before anything is opened; no list of paths is made.  The schema is that of the
    first file, or with ``merge_schema`` (Parquet) the union of the files' schemas, whose
    footers the tasks read (missing columns are null).
    """
    where = resolved_root(spark, root)
    files = discover_files(spark, root, contains, store)
    first = files.agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no file below {root} has {contains!r} in its path")
    reader = spark.read.format(fmt).options(**options)
    if merge_schema and fmt == "parquet" and reachable(store, where):
        schema = merged_schema(file_schemas(files, where, store))
    elif merge_schema:
        schema = reader.option("mergeSchema", "true").option("recursiveFileLookup", "true").load(root).schema
    else:
        schema = reader.load("".join(f"\\{c}" if c in "[]{}*?\\" else c for c in first)).schema
    tree = spark.read.format(fmt).options(**options).schema(schema).option("recursiveFileLookup", "true").load(root)
    tree = tree.withColumn("source_file", plain_path(F.col("_metadata.file_path")))
    tree = tree.withColumn("relative", relative_path(F.col("source_file"), where))
    return tree.where(F.col("relative").contains(contains))
