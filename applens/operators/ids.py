"""Dense integer ids for string keys.

``dense_index`` numbers the distinct values 1..n in sort order without a
single-partition window.  The distinct keys are range-partitioned, sorted and
written once, each with its partition and its place in it; sizes and numbers
both come from that one result, so the numbering cannot differ from the sizes
it is shifted by.  One size per partition becomes an offset and goes back as a
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.session import pinned

_PLACE_BITS = 33      # monotonically_increasing_id: the partition above, the place in it below


def dense_index(df: DataFrame, key: str, id_col: str = "dense_id",
                num_partitions: int | None = None) -> DataFrame:
    """(key, id) for each distinct non-null key, ids 1..n in key order.

    Without ``num_partitions`` AQE merges small ranges.
    """
    keys = df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    ranges = keys.repartitionByRange(num_partitions, "_key") if num_partitions else keys.repartitionByRange("_key")
    mark = F.monotonically_increasing_id()
    placed = pinned(ranges.sortWithinPartitions("_key").withColumn("_mark", mark)
                    .select("_key", F.shiftright("_mark", _PLACE_BITS).cast("int").alias("_part"),
                            F.col("_mark").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place")))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offsets), "_part")
            .select(F.col("_key").alias(key), (F.col("_off") + F.col("_place") + 1).cast("bigint").alias(id_col)))
