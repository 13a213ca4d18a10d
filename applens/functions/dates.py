"""Epoch / calendar helpers that do not depend on the session time zone.

Epoch values are turned into ``timestamp_ntz`` by adding them to the NTZ
epoch, then shifted with ``convert_timezone`` when a zone other than UTC is
wanted.  Formatting an NTZ value never consults ``spark.sql.session.timeZone``,
so results are the same on every session the functions run in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from applens.functions.text import col

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

# Output formats (fixed values).
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ROUTE_FORMAT = "yyyy/MM/dd/"

# Epoch milliseconds of the years 1 to 9999, less a day on either side for time zones.
MIN_MS, MAX_MS = -62_135_510_400_000, 253_402_214_399_999


def epoch_ms_to_ntz(ms, zone: str = "UTC") -> Column:
    """Epoch millis -> local date-time; NULL outside the years 1 to 9999."""
    ts = F.when(col(ms).between(MIN_MS, MAX_MS), F.timestamp_add("MILLISECOND", col(ms), _epoch_ntz()))
    if zone.upper() != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return ts


def format_epoch_ms(ms, fmt: str = DATETIME_FORMAT, zone: str = "UTC") -> Column:
    return F.date_format(epoch_ms_to_ntz(ms, zone), fmt)


def date_route(ms, zone: str = "UTC") -> Column:
    """Epoch millis -> ``yyyy/MM/dd/`` directory key."""
    return format_epoch_ms(ms, ROUTE_FORMAT, zone)


def route_parts(ms, zone: str = "UTC") -> list[Column]:
    """Epoch millis -> year, month, day strings (partition columns)."""
    ts = epoch_ms_to_ntz(ms, zone)
    return [F.date_format(ts, "yyyy").alias("year"),
            F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day")]


def epoch_millis(ts_ntz) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), col(ts_ntz))


def parse_sec_millis(c) -> Column:
    """``"1600000000.250"`` -> 1600000000250: drop the dots, parse a long.

    Anything that is not an optionally signed run of digits after removing
    dots (or that overflows a long, or lies outside the years 1 to 9999) gives
    NULL, the row-level parse failure.
    """
    digits = F.regexp_replace(col(c), r"\.", "")
    return valid_ms(F.when(digits.rlike(r"^[+-]?[0-9]+\z"), digits.try_cast("bigint")))


def valid_ms(ms) -> Column:
    """The value if it is a time that can be written as a date, else NULL."""
    return F.when(col(ms).between(MIN_MS, MAX_MS), col(ms))


def to_month_start(yyyymm) -> Column:
    """``yyyyMM`` string -> first day of that month (NULL if not a month)."""
    c = col(yyyymm)
    return F.when(c.rlike(r"^[0-9]{4}(0[1-9]|1[0-2])\z"),
                  F.make_date(F.substring(c, 1, 4).cast("int"),
                              F.substring(c, 5, 2).cast("int"), F.lit(1)))


def add_month(yyyymm) -> Column:
    """``yyyyMM`` -> the following ``yyyyMM`` (December rolls the year)."""
    return F.date_format(F.add_months(to_month_start(yyyymm), 1), "yyyyMM")


def month_days(yyyymm) -> Column:
    """Every calendar day of a ``yyyyMM`` month, as an array of dates."""
    start = to_month_start(yyyymm)
    return F.sequence(start, F.date_sub(F.add_months(start, 1), 1),
                      F.expr("INTERVAL 1 DAY"))
