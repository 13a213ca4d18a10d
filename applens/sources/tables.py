"""Stored tables by path or by catalogue name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def is_path(source: str) -> bool:
    """Whether ``source`` names a place (it has a slash) rather than a table of the catalogue."""
    return "/" in source


def read_table(spark: SparkSession, source: str, ddl: str | None = None) -> DataFrame:
    """A Parquet directory or a catalogue table.

    ``ddl`` keeps partition values of a directory as the types it names, which
    inference would turn into numbers; a catalogue table has its own types.
    """
    if not is_path(source):
        return spark.table(source)
    return (spark.read.schema(ddl) if ddl else spark.read).parquet(source)


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """``df`` in at least as many partitions as the session runs tasks.

    A scan of few splits (a small file, one row group) leaves cores idle through whatever is done to its rows,
    so its raw rows are dealt out first, which is cheap next to parsing them.  A scan of as many splits
    as there are cores, as any large table has, is left as it is and nothing is shuffled.
    """
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= tasks else df.repartition(tasks)
