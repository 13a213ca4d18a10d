"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import pinned

MAX_ROUNDS = 60      # each round at least halves the longest path; not reaching the end is an error
TASKS = 8            # tasks of a step over few links
TASK_LINKS = 25_000  # links a task takes before there are more tasks


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the smallest node reachable.

    Large-star and small-star steps in turn until the links no longer change;
    each round's links are kept in the shared folder, so lineage stays short.
    The minimum of a node's neighbours is an aggregate, so a node with very
    many links is summed up before the shuffle.  Steps over few links run as few tasks, however wide the
    session shuffles: a round has six shuffles, and each would leave files of every task of the one before.
    """
    edges = pinned(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n = edges.count()
    for _ in range(MAX_ROUNDS):
        tasks = max(TASKS, -(-n // TASK_LINKS))
        edges = edges.coalesce(tasks)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").coalesce(tasks).distinct().coalesce(tasks))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(down.select("u", F.col("m").alias("v"))).filter("u <> v").coalesce(tasks).distinct().coalesce(tasks))
        new = pinned(small)
        before, n = n, new.count()
        if n == before and new.exceptAll(edges).isEmpty():
            break
        edges = new
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
