"""Delimited text sources: rating files, item dimensions, plain lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.functions.text import col

RATING_COLUMNS = ["user_id", "item_id", "rating", "ts"]
RATING_TYPES = ["int", "int", "double", "bigint"]
_NEWLINE = r"\r\n|\r|\n"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) -> one row per line (``value``)."""
    return spark.read.text(path)


def line_count(c) -> Column:
    """Lines a text reader would return for this text (trailing newline ends the
    last line rather than starting an empty one; an empty text has none)."""
    c = col(c)
    body = F.regexp_replace(c, f"(?:{_NEWLINE})\\z", "")
    return F.when(F.length(c) == 0, F.lit(0)).otherwise(F.size(F.split(body, _NEWLINE)))


def explode_lines(df: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """One row per line of ``text_col`` (same line rule as :func:`line_count`)."""
    c = F.col(text_col)
    body = F.regexp_replace(c, f"(?:{_NEWLINE})\\z", "")
    lines = F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(body, _NEWLINE))
    return df.select(*(keep or []), F.explode(lines).alias("value"))


def parse_delimited_ratings(lines: DataFrame, sep: str = "::", fields: int = 4,
                            value_col: str = "value") -> DataFrame:
    """``user<sep>item<sep>rating[<sep>ts]`` lines -> typed rating rows.

    Casts are strict (ANSI): a malformed number fails the job, as a bad
    rating file should.  With a timestamp the ``bucket`` column is its last
    decimal digit, the key of the deterministic splits.
    """
    parts = F.split(F.col(value_col), re.escape(sep))
    out = [F.element_at(parts, i + 1).cast(t).alias(n)
           for i, (n, t) in enumerate(zip(RATING_COLUMNS[:fields], RATING_TYPES[:fields]))]
    df = lines.select(*out)
    if fields >= 4:
        df = df.withColumn("bucket", F.col("ts") % 10)
    return df


def read_ratings(spark: SparkSession, path: str, sep: str = "::", fields: int = 4,
                 strict_width: bool = False) -> DataFrame:
    """Rating text files.  ``strict_width`` also fails the job on a line with a different
    number of fields (the comma format requires exactly three), in the same pass."""
    if strict_width:
        parts = F.split("value", re.escape(sep))
        n = F.size(parts)
        checked = F.when(n == fields, F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit(f"{path}: not {fields} fields: "), F.col("value"))))
        return parse_delimited_ratings(read_lines(spark, path).select(checked.alias("value")), sep, fields)
    ddl = ", ".join(f"{n} {t}" for n, t in zip(RATING_COLUMNS[:fields], RATING_TYPES[:fields]))
    df = (spark.read.schema(ddl).option("sep", sep).option("mode", "FAILFAST")
          .option("enforceSchema", "true").csv(path))
    if fields >= 4:
        df = df.withColumn("bucket", F.col("ts") % 10)
    return df


def check_widths(lines: DataFrame, sep: str = ",", fields: int = 3, value_col: str = "value") -> DataFrame:
    """``lines`` with the ``width`` of each and whether the strict reader would ``abort`` on it: what to look at, or to
    leave out, before a file is read with ``strict_width``."""
    width = F.size(F.split(F.col(value_col), re.escape(sep)))
    return lines.withColumn("width", width).withColumn("abort", F.col("width") != fields)


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) -> ``value`` and ``pos``, which orders lines as they lie: by file path, then by
    the split's place in the file, then by the line's place in the split."""
    meta = F.col("_metadata")
    # a split's lines keep their order, and so does the id that numbers them
    return spark.read.text(path).select("value", F.struct(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("line")).alias("pos"))


def parse_items(lines: DataFrame, sep: str = "::", value_col: str = "value",
                dedupe: bool = True, pos_col: str | None = None) -> DataFrame:
    """``item<sep>name[<sep>...]`` -> (item_id, name).

    A repeated id keeps its last line (map semantics) by ``pos_col`` (see
    :func:`read_ordered_lines`); without one, lines are taken in the order of the
    frame's partitions.  The dimension stays distributed and is reduced
    with ``max_by`` (partial aggregation map-side).
    """
    parts = F.split(F.col(value_col), re.escape(sep))
    pos = F.col(pos_col) if pos_col else F.monotonically_increasing_id()
    items = lines.select(F.element_at(parts, 1).cast("int").alias("item_id"),
                         F.element_at(parts, 2).alias("name"), pos.alias("_pos"))
    if not dedupe:
        return items.drop("_pos")
    return items.groupBy("item_id").agg(F.max_by("name", "_pos").alias("name"))
