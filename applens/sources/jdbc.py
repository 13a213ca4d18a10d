"""JDBC tables: range-partitioned scans, pushed-down queries, truncate/append.

Connection settings (url, user, password, driver) always come from the
caller; nothing is hard-coded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from applens.operators.models import known_models


def read_range_partitioned(spark: SparkSession, url: str, table: str, column: str,
                           lower: int, upper: int, num_partitions: int,
                           props: dict | None = None, fetch_size: int | None = None) -> DataFrame:
    """Parallel scan: ``num_partitions`` range predicates on ``column``.

    The bounds only shape the stride; rows outside them still arrive (in the
    first and last partitions).  ``table`` may be a parenthesised subquery.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", column).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    if fetch_size:
        reader = reader.option("fetchsize", str(fetch_size))
    for k, v in (props or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_query(spark: SparkSession, url: str, query: str, props: dict | None = None) -> DataFrame:
    """Run ``query`` in the database (joins/grouping happen there)."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (props or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_known_models(spark: SparkSession, url: str, models_table: str, makers_table: str,
                      columns: dict[str, str] | None = None, props: dict | None = None) -> DataFrame:
    """Catalogue (model, manufacturer) pairs from the two tables of a database.

    ``columns`` maps ``phonemodelcode``, ``manufacturerid`` and ``manufacturername`` to
    other names.  Only these columns are read; the join and its rules are :func:`applens.operators.models.known_models`.
    """
    names = {c: c for c in ("phonemodelcode", "manufacturerid", "manufacturername")} | (columns or {})

    def pairs(table: str, code: str) -> DataFrame:
        sql = f"SELECT DISTINCT {names[code]}, {names['manufacturerid']} FROM {table}"
        return read_query(spark, url, sql, props).toDF(code, "manufacturerid")

    return known_models(pairs(models_table, "phonemodelcode"), pairs(makers_table, "manufacturername"))


def append(df: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    df.write.mode("append").jdbc(url, table, properties=props or {})


def truncate(spark: SparkSession, url: str, table: str, props: dict | None = None) -> None:
    """Empty a table but keep its definition (TRUNCATE, not DROP)."""
    schema = read_query(spark, url, f"SELECT * FROM {table} WHERE 1 = 0", props).schema
    (spark.createDataFrame([], schema).write.mode("overwrite").option("truncate", "true")
     .jdbc(url, table, properties=props or {}))
