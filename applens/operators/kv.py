"""Key-value device reports -> routed, delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.functions import dates
from applens.functions.text import blank_to_space, is_not_blank
from applens.functions.tokens import format_app_list, parse_app_list

# The fields of an exported line, in output order (fixed values).
KV_FIELDS = ["source", "processType", "serverIp", "optTime", "serviceProvider",
             "netType", "firstImei", "secondImei", "thirdImei", "channelNumber",
             "flag", "phoneBrand", "phoneModel", "appList", "counterPkg",
             "counterCrc32", "longitude", "latitude", "simStatus", "simSequence",
             "identity", "arriveTimes", "acceptTimestamp"]

ROWKEY_HASH_LEN = 32
DATE_PARTITION = "keydate"


def rowkey_date(rowkey: str = "rowkey"):
    """The ``yyyyMMdd`` that follows the hash in a row key."""
    return F.substring(rowkey, ROWKEY_HASH_LEN + 1, 8)


def write_kv_table(kv: DataFrame, path: str) -> None:
    """Store key-value rows by the date in their key, so a scan of a date reads its directory alone."""
    (kv.withColumn(DATE_PARTITION, rowkey_date()).hint("rebalance", DATE_PARTITION)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE_PARTITION).parquet(path))


def read_kv_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored table, dates as strings."""
    return spark.read.schema(f"rowkey STRING, scf MAP<STRING, STRING>, {DATE_PARTITION} STRING").parquet(path)


def rowkey_date_filter(kv: DataFrame, date_arg: str, regex: bool = False) -> DataFrame:
    """Rows whose key has ``date_arg`` right after the 32-char hash.

    ``regex=True`` keeps the original contract (the argument is a regular
    expression, ``^.{32}<arg>.*$``); the default compares the literal
    substring, which is cheaper and cannot be mis-read as a pattern.  An argument of
    digits alone is compared as text before the pattern is tried, and also prunes a table that
    :func:`write_kv_table` stored.
    """
    if DATE_PARTITION in kv.columns and date_arg.isdigit():
        kv = kv.where(F.col(DATE_PARTITION).startswith(date_arg[:8]))
    if regex and date_arg.isdigit():
        kv = kv.where(F.substring("rowkey", ROWKEY_HASH_LEN + 1, len(date_arg)) == date_arg)
    if regex:
        return kv.where(F.col("rowkey").rlike(f"^.{{{ROWKEY_HASH_LEN}}}{date_arg}.*$"))
    return kv.where(F.substring("rowkey", ROWKEY_HASH_LEN + 1, len(date_arg)) == date_arg)


def project(kv: DataFrame, fields: list[str] = KV_FIELDS, family: str = "scf") -> DataFrame:
    """``rowkey`` plus one string column per requested qualifier."""
    return kv.select("rowkey", *[F.col(family)[q].alias(q) for q in fields])


def checked_reports(kv: DataFrame, zone: str = "UTC") -> DataFrame:
    """The projected fields with ``route`` (``yyyy/MM/dd/`` of the accept time in ``zone``) and ``reject``:
    why a report cannot be exported (``no_app_list``, ``bad_time``), or NULL."""
    p = project(kv)
    accept_ms = F.when(F.col("acceptTimestamp").rlike(r"^[+-]?[0-9]+\z"),
                       F.col("acceptTimestamp").try_cast("bigint"))
    p = p.select("*", dates.date_route(accept_ms, zone).alias("route"))
    reject = (F.when(F.col("appList").isNull(), "no_app_list")
              .when(~is_not_blank("route"), "bad_time"))
    return p.withColumn("reject", reject)


def report_lines(kv: DataFrame, zone: str = "UTC") -> DataFrame:
    """Each report -> (``route`` = ``yyyy/MM/dd/`` of its accept time in ``zone``, ``line``).

    ``line`` is the 23 fields joined by ``|`` with blanks written as a single
    space, the app list replaced by its parsed ``crc,pkg[,name];...`` form.
    Unreadable reports (see :func:`rejected_reports`) are left out; that is
    decided on two cheap fields before the line is built, so the app-list parse
    runs once per kept row.
    """
    p = checked_reports(kv, zone).where(F.col("reject").isNull())
    others = [q for q in KV_FIELDS if q != "appList"]
    p = p.select("rowkey", "route", *others,
                 format_app_list(parse_app_list("appList", "processType")).alias("appList"))
    # kept rows have a route, and a line holds its separators, so neither is blank.  A filter on the line would
    # say nothing and have it built twice, once for the filter where the scan is
    return p.select("rowkey", "route", F.concat_ws("|", *[blank_to_space(q) for q in KV_FIELDS]).alias("line"))


def rejected_reports(kv: DataFrame, zone: str = "UTC") -> DataFrame:
    """Quarantine output: key and reason of the reports that :func:`report_lines` leaves out."""
    return checked_reports(kv, zone).where(F.col("reject").isNotNull()).select("rowkey", "acceptTimestamp", "reject")


def nonblank(df: DataFrame, key: str = "route", value: str = "line") -> DataFrame:
    """Routed lines that have both a route and something to write."""
    return df.where(is_not_blank(key) & is_not_blank(value))


def key_list_date_line(kv: DataFrame) -> DataFrame:
    """``rowkey|packagelist|cdate`` lines (a missing value prints ``null``)."""
    nul = lambda c: F.coalesce(F.col("scf")[c], F.lit("null"))
    return kv.select("rowkey", F.concat_ws("|", F.col("rowkey"), nul("packagelist"), nul("cdate"))
                     .alias("line"))
