"""Session helpers: a tuned builder for tests/bench and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every load relies on. AQE re-plans joins from runtime sizes
# (broadcast conversion, skew splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lookups into mid-size dims: AQE swaps sort-merge for a shuffled hash
    # join (no sort) when every post-shuffle partition's build side is small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "landstage", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (a cluster passes its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LANDSTAGE_DRIVER_MEMORY", "16g")
    # Small local inputs: let AQE coalesce tiny shuffles only down to ~64KB
    # partitions (default 1MB), so a stage that fans rows out after a small
    # shuffle (lookup chains, cross unpivot) still uses every core.
    conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "64k"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """True for a single-machine master (``local``, ``local[n]``), not for ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; a temporary local folder is only created when nothing is set and
    the master is local (tests).  Elsewhere a machine-local folder could not be
    shared, so a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, read the setting only
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="landstage-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def session_id(spark: SparkSession) -> str:
    """Identity of the running application (for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return str(id(spark))


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles in here is removed from the disks when it ends, not when the driver next collects its garbage.

    For writes of frames that are not used again: such a frame would be shuffled anew.
    """
    old = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if old is None else spark.conf.set(FILE_CLEANUP, old)


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A path for an intermediate table under the shared checkpoint root.

    Its folder is removed when the application ends.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{root}/landstage-{name}-{uuid.uuid4().hex}"
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the folder stays
        return f"{folder}/data"
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/data"
