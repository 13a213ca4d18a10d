"""Arrival reports: device id resolution, app-list explode, daily partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.functions import dates
from applens.functions.text import first_nonblank_id
from applens.sources.tables import is_path, read_table

ARRIVALS_DDL = ("firstimei STRING, secondimei STRING, thirdimei STRING, "
                "applist ARRAY<STRUCT<signcrc32: STRING, pkg: STRING, appname: STRING>>, "
                "arrivetimes INT, year STRING, month STRING, day STRING")

APP_DETAIL_COLUMNS = ["imei", "appname", "pkg", "signcrc32", "arrivetimes", "year", "month", "day"]
APP_DETAIL_DDL = ("imei STRING, appname STRING, pkg STRING, signcrc32 STRING, "
                  "arrivetimes INT, year STRING, month STRING, day STRING")


def resolve_imei(df: DataFrame, ids=("firstimei", "secondimei", "thirdimei")) -> DataFrame:
    """Add ``imei``: the first of the ids that is not the blank placeholder."""
    return df.withColumn("imei", first_nonblank_id(*ids))


def check_month(yyyymm: str) -> str:
    if len(yyyymm) != 6 or not yyyymm.isdigit() or not 1 <= int(yyyymm[4:]) <= 12:
        raise ValueError(f"month must be yyyyMM, got {yyyymm!r}")
    return yyyymm


def date_parts() -> list[Column]:
    """year, month and day as strings of four, two and two digits, whatever type and form a table stores them in."""
    return [F.lpad(F.col(c).cast("string"), n, "0").alias(c) for c, n in (("year", 4), ("month", 2), ("day", 2))]


def read_arrivals(spark: SparkSession, source: str) -> DataFrame:
    """Nested reports from a path or a catalogue table; partition values stay strings (``05`` is not read as 5)."""
    return read_table(spark, source, ARRIVALS_DDL)


def month_filter(df: DataFrame, yyyymm: str | None) -> DataFrame:
    """Rows of one ``yyyyMM`` month.  The predicate uses the partition columns
    alone, so a partitioned table prunes to that month's directories."""
    if yyyymm is None:
        return df
    check_month(yyyymm)
    year, month, _ = date_parts()
    return df.where((year == yyyymm[:4]) & (month == yyyymm[4:]))


def explode_app_detail(arrivals: DataFrame, yyyymm: str | None = None) -> DataFrame:
    """One row per (device report, app): ``imei, appname, pkg, signcrc32,
    arrivetimes, year, month, day``.

    Reports with a NULL (or empty) app list produce no rows.  ``inline`` is a
    generator in the same stage as the scan: no shuffle, no Python.
    """
    src = month_filter(arrivals, yyyymm).where(F.col("applist").isNotNull())
    return (resolve_imei(src)
            .select("imei", "arrivetimes", *date_parts(), F.inline("applist"))
            .select(*APP_DETAIL_COLUMNS))


def month_days_table(months: DataFrame, month_col: str = "yyyymm") -> DataFrame:
    """Every calendar day of each month in ``months``: the partitions a monthly
    rewrite covers."""
    d = F.explode(dates.month_days(month_col)).alias("d")
    return months.select(month_col, dates.add_month(month_col).alias("next_month"), d).select(
        month_col, "next_month",
        F.date_format("d", "yyyy").alias("year"),
        F.date_format("d", "MM").alias("month"),
        F.date_format("d", "dd").alias("day"))


def write_app_detail(spark: SparkSession, detail: DataFrame, target: str,
                     replace_whole_month: str | None = None) -> None:
    """Overwrite the daily partitions present in ``detail``, in a path or a catalogue table.

    Dynamic partition overwrite replaces exactly the days that have rows and
    leaves the others; each day is staged and swapped in at commit, so a
    failed job leaves the table as it was.  ``replace_whole_month='yyyyMM'``
    additionally empties that month's days that got no rows (what a static
    per-day overwrite of every calendar day does); those stale days are
    removed only after the new data is committed, and never if the new data has no day of that month.
    """
    out = detail.select(*[c for c in APP_DETAIL_COLUMNS if c not in ("year", "month", "day")], *date_parts())
    kept_days: set[str] = set()
    if replace_whole_month:
        # at most 31 values: the days of that month the new data covers
        kept_days = {r["day"] for r in month_filter(out, replace_whole_month)
                     .select("day").distinct().collect()}
        if not kept_days:
            raise ValueError(f"no rows for {replace_whole_month}: its days are left as they are")
    # rebalance (not repartition): AQE splits a day holding a large share of
    # the rows into several write tasks and merges small days
    out = out.hint("rebalance", "year", "month", "day")
    if is_path(target):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month", "day").parquet(target))
    else:
        _insert_dynamic(spark, out.select(spark.table(target).columns), target)
    if replace_whole_month:
        drop = _drop_stale_days if is_path(target) else _drop_stale_table_days
        drop(spark, target, replace_whole_month, kept_days)


def _insert_dynamic(spark: SparkSession, df: DataFrame, table: str) -> None:
    """``insertInto`` takes the overwrite mode from the session alone, so it is set for this write and put back."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)


def _stale_days(found: dict[str, str], kept_days: set[str]) -> list[str]:
    """Of the listed days (stored value -> two digits) those that the new data does not have."""
    if not kept_days & set(found.values()):
        raise RuntimeError("none of the days just written is listed; nothing is removed")
    return [stored for stored, day in found.items() if day not in kept_days]


def _drop_stale_days(spark: SparkSession, path: str, yyyymm: str, kept_days: set[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    month_dir = jvm.org.apache.hadoop.fs.Path(f"{path}/year={yyyymm[:4]}/month={yyyymm[4:]}")
    fs = month_dir.getFileSystem(conf)
    names = [st.getPath().getName() for st in fs.listStatus(month_dir) if st.isDirectory()]
    days = {n[4:]: n[4:].zfill(2) for n in names if n.startswith("day=")}
    for day in _stale_days(days, kept_days):
        fs.delete(jvm.org.apache.hadoop.fs.Path(month_dir, f"day={day}"), True)


def _drop_stale_table_days(spark: SparkSession, table: str, yyyymm: str, kept_days: set[str]) -> None:
    listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION (year='{yyyymm[:4]}', month='{yyyymm[4:]}')").collect()
    days = {r[0].rpartition("day=")[2]: r[0].rpartition("day=")[2].zfill(2) for r in listed}      # at most 31
    for day in _stale_days(days, kept_days):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year='{yyyymm[:4]}', month='{yyyymm[4:]}', day='{day}')")


def read_app_detail(spark: SparkSession, source: str) -> DataFrame:
    """Read the partitioned table with string partition values (``05`` stays
    ``05`` rather than being inferred as the integer 5)."""
    return read_table(spark, source, APP_DETAIL_DDL)
