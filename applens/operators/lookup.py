"""Prefix lookup: for each id, the first row (in key order) whose key starts with it.

A ``startswith`` join condition is not an equi-join, so Spark would plan a
nested-loop / Cartesian product.  Instead:

1. the distinct id lengths are read (a handful of integers, bounded by the
   longest id);
2. every table key is cut to its prefixes of exactly those lengths; of these
   only the prefixes that are asked for go on, and the smallest key per prefix
   is kept (``min`` aggregates partially on the map side, so a prefix shared by
   a third of the table ships one row per task).  Values do not take part;
3. the few winning keys fetch their values by an equi-join, and ids equi-join
   the winners.  Duplicate ids each get the answer, ids without a match get
   none, blank ids are skipped (an empty prefix would match the whole table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions.text import is_not_blank


def prefix_lengths(ids: DataFrame, id_col: str = "id") -> list[int]:
    rows = (ids.where(is_not_blank(id_col)).select(F.length(id_col).alias("n"))
            .distinct().collect())
    return sorted(r["n"] for r in rows)


def first_key_per_prefix(table: DataFrame, prefixes: DataFrame, lengths: list[int],
                         key_col: str = "rowkey") -> DataFrame:
    """(prefix, key): the smallest key that starts with each of ``prefixes``."""
    cuts = [F.when(F.length(key_col) >= n, F.substring(key_col, 1, n)) for n in lengths]
    cut = (table.select(F.explode(F.array(*cuts).cast("array<string>")).alias("prefix"), key_col)
           .where(F.col("prefix").isNotNull()))
    return (cut.join(prefixes.select("prefix"), "prefix", "left_semi")
            .groupBy("prefix").agg(F.min(key_col).alias(key_col)))


def prefix_first_match(ids: DataFrame, table: DataFrame, id_col: str = "id",
                       key_col: str = "rowkey", value_cols: list[str] | None = None) -> DataFrame:
    """Columns of ``ids``, then the key and ``value_cols`` of its first row.  Keys are unique in ``table``."""
    value_cols = value_cols or []
    probe = ids.where(is_not_blank(id_col))
    asked = probe.select(F.col(id_col).alias("prefix")).distinct()
    winners = first_key_per_prefix(table, asked, prefix_lengths(ids, id_col), key_col)
    if value_cols:
        winners = table.select(key_col, *value_cols).join(winners, key_col)
    return (probe.join(winners, probe[id_col] == winners["prefix"])
            .select(*[probe[c] for c in ids.columns], key_col, *value_cols))
