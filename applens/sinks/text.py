"""Text sinks: single-file output and date-routed appends.

A routed record ``(route='yyyy/MM/dd/', line)`` goes under
``<root>/year=yyyy/month=MM/day=dd/``; each write adds new part files through
Spark's commit protocol, so concurrent or repeated appends never overwrite
each other's files and a failed task leaves nothing half-written.
:func:`append_batch` also makes a failed and repeated job append its lines once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUTED_SCHEMA = "line string, year string, month string, day string"


def route_columns(df: DataFrame, route_col: str = "route") -> DataFrame:
    parts = F.split(F.col(route_col), "/")
    return df.select("*", F.try_element_at(parts, F.lit(1)).alias("year"),
                     F.try_element_at(parts, F.lit(2)).alias("month"),
                     F.try_element_at(parts, F.lit(3)).alias("day"))


def write_routed(df: DataFrame, root: str, route_col: str = "route", line_col: str = "line",
                 compression: str | None = None, mode: str = "append",
                 concurrent_writers: bool = False) -> None:
    """Append ``line`` text under the day directory named by ``route``.

    Rows are clustered by day first so each task writes few files; the
    ``rebalance`` hint lets AQE split a day that holds a large share of the
    rows across several tasks.  With
    ``concurrent_writers`` several jobs may append to the same root at once:
    tasks commit their (uniquely named) files straight into place and no job
    removes the shared staging folder another job is still using.  Such a job that
    fails halfway leaves the lines of its finished tasks behind, and a rerun
    appends them again; :func:`append_batch` does not.
    """
    out = route_columns(df, route_col).select(line_col, "year", "month", "day")
    w = (out.hint("rebalance", "year", "month", "day").write.mode(mode)
         .partitionBy("year", "month", "day"))
    if compression:
        w = w.option("compression", compression)
    if concurrent_writers:
        w = (w.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
             .option("mapreduce.fileoutputcommitter.cleanup.skipped", "true"))
    w.text(root)


def append_batch(df: DataFrame, root: str, batch: str, route_col: str = "route", line_col: str = "line",
                 compression: str | None = None) -> None:
    """Append the lines of one named batch, once however often it is run.

    The batch is written whole under ``<root>/_batches/<batch>``, which readers of ``root`` skip, and its
    files are then renamed into their days with the batch's name in front.  A run that failed before that leaves
    nothing that readers see; one that failed between two renames has its files removed by the next
    run of the same batch, which puts them all in again.  Batches of other names may be appended at the same time.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.]*", batch):
        raise ValueError(f"a batch name holds letters, digits and dots only: {batch!r}")
    spark = df.sparkSession
    staged = f"{root.rstrip('/')}/_batches/{batch}"
    write_routed(df, staged, route_col, line_col, compression, mode="overwrite")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    day = "year=*/month=*/day=*"
    for old in fs.globStatus(path(f"{root}/{day}/{batch}-*")) or []:
        fs.delete(old.getPath(), False)
    for new in fs.globStatus(path(f"{staged}/{day}/part-*")) or []:
        into = path(f"{root}/" + "/".join(str(new.getPath()).split("/")[-4:-1]))
        fs.mkdirs(into)
        if not fs.rename(new.getPath(), path(into, f"{batch}-{new.getPath().getName()}")):
            raise OSError(f"could not move {new.getPath()} into {into}")
    fs.delete(path(staged), True)


def read_routed(spark: SparkSession, root: str) -> DataFrame:
    """(route, line) of routed lines, with the route recovered from the directory."""
    back = spark.read.schema(ROUTED_SCHEMA).text(root)
    return back.select(F.concat("year", F.lit("/"), "month", F.lit("/"), "day", F.lit("/")).alias("route"), "line")


def write_single_file(df: DataFrame, path: str, line_col: str = "line",
                      mode: str = "overwrite") -> None:
    """One output file.  Only for small results: everything passes one task."""
    df.select(line_col).repartition(1).write.mode(mode).text(path)
