"""Shared pieces of the corpus operators: reading, byte texts, shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: the characters the contracts call white space, [\x20\x09-\x0D]
SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = "[^ \\t\\n\\x0B\\f\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a session on one machine (``local...``) that names none gets a
    temporary folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if not configured:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="applens-shared-")
        sc.setCheckpointDir(configured)
    return (configured or sc.getCheckpointDir()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/applens-{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that :func:`scratch` named, in whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, without its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, a few rows at a time in memory; null counts as empty."""
    column = column.cast(pa.binary())
    for at in range(0, len(column), 64):
        for x in column.slice(at, 64).to_pylist():
            yield x or b""


# where the library lies; workers on the driver's machine may have no other way to it
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tidy(run):
    """A task over Arrow batches that finds this library where the driver has it, if the worker's own path
    has none, and gives back Arrow's freed memory at its end, as workers outlive their tasks."""
    packed, root = cloudpickle.dumps(run), _ROOT

    def task(batches):
        import sys

        import pyarrow
        from pyspark import cloudpickle as loader
        if root not in sys.path:
            sys.path.append(root)
        yield from loader.loads(packed)(batches)
        pyarrow.default_memory_pool().release_unused()
    return task


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns an operator needs, under fixed names, so that further columns never clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
