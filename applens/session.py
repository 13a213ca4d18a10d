"""Session construction and the few runtime settings the library relies on.

Jobs build their own session with :func:`build_session`.  Query functions are
also handed sessions built by someone else and leave their settings alone.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every job session gets.  Sized for a large cluster; tests and the
# local bench override shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Broadcast only what is provably small; AQE may still convert at runtime
    # from measured (not estimated) sizes.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.network.timeout": "600s",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Initial shuffle width of a job that says nothing about its size.  AQE merges small partitions and splits
# skewed join partitions, but never splits ordinary ones, so a job that shuffles much
# more than this many times SHUFFLE_PARTITION_BYTES must say so (``shuffle_bytes``).
CLUSTER_SHUFFLE_PARTITIONS = 16384
SHUFFLE_PARTITION_BYTES = 256 << 20


def partitions_for(shuffle_bytes: int) -> int:
    """Shuffle width that gives partitions of SHUFFLE_PARTITION_BYTES: 100 TB needs about 400,000."""
    return max(1, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(app_name: str = "applens", master: str | None = None,
                  shuffle_partitions: int | None = None, shuffle_bytes: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    width = shuffle_partitions or (partitions_for(shuffle_bytes) if shuffle_bytes else CLUSTER_SHUFFLE_PARTITIONS)
    conf["spark.sql.shuffle.partitions"] = str(width)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where nothing is configured, a session on one machine (``local...``: unit tests, a
    laptop) gets a temporary folder; on a cluster that is an error, as a folder of one machine would lose data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="applens-checkpoints-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for written tables."""
    root = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    return f"{root}/applens-{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch directory, in whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, without its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once for the outputs written from it inside the block, then released; partitions of a lost
    executor are computed again."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
