"""Best unrated items of every user, by blocks of users against blocks of items.

Items are taken in turns by the length of their factors, the longest first, each
turn ``GROWTH`` times the items so far.  A user's best ``n`` of the turns before
are its floor: a later item is listed only if it beats that, and neither users nor
items whose lengths rule that out are scored (a product is at most the product of
the lengths).  Within a turn users and items are dealt to cells of at most
``block`` users and items, each cell keeps a user's best ``n`` unrated items of
its block that pass the floor, and the lists of a user's cells are merged.  What is
shuffled is, a turn, a copy of the users per item block, of the items per user
block, each rated pair once, and a few times ``n`` rows per user, however many cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.session import pinned

try:  # ship the cell function with the job so executors need no install
    import sys as _sys
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, KeyError):  # pragma: no cover
    pass

BLOCK = 1 << 16
GROWTH = 4               # items of a turn over all items of the turns before
_LEAST = 256             # users a cell has before there are more cells than cores need
_SLACK = 1 + 1e-9        # rounding of lengths and products
_STRIP = 1 << 21         # scores held at once in a cell


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return np.asarray(rows.flatten(), np.float64).reshape(len(rows), -1)


def _lengths(rows: np.ndarray) -> np.ndarray:
    """Lengths of factors; endless if they are no number."""
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt((rows * rows).sum(axis=1))
    return np.where(length < np.inf, length, np.inf)


def best_of_cell(users: np.ndarray, user_rows: np.ndarray, floor: tuple[np.ndarray, np.ndarray], items: np.ndarray, item_rows: np.ndarray,
                 rated: tuple[np.ndarray, np.ndarray], n: int, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(user, item, score) of each user's best ``n`` items that come before its ``floor`` (score, item; -inf for none); ties go
    to the smaller item."""
    length, reach = _lengths(item_rows), _lengths(user_rows)
    by_length = np.argsort(-length, kind="stable")
    items, item_rows, length = items[by_length], item_rows[by_length], length[by_length]
    with np.errstate(divide="ignore", invalid="ignore"):
        need = floor[0] / (reach * _SLACK)
    # an item shorter than this cannot pass; floors of 0 and below rule nothing out, as a product of 0 is no shorter than them
    need = np.where((floor[0] > 0) & (need == need), need / _SLACK, 0.0)
    by_need = np.argsort(-need, kind="stable")
    users, user_rows, need, least, last = users[by_need], user_rows[by_need], need[by_need], floor[0][by_need], floor[1][by_need]
    user_at, item_at = np.argsort(users), np.argsort(items)
    at_user = user_at[np.searchsorted(users, rated[0], sorter=user_at)]
    at_item = item_at[np.searchsorted(items, rated[1], sorter=item_at)]
    by_user = np.argsort(at_user, kind="stable")
    at_user, at_item = at_user[by_user], at_item[by_user]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    reached = np.searchsorted(-length, -need, "right")       # items that a user needs, more and more of them
    low = int(np.searchsorted(reached, 1))
    while low < len(users):
        ahead = reached[low:low + _STRIP // int(reached[low]) + 1]
        high = low + max(1, int(np.searchsorted(ahead * np.arange(1, len(ahead) + 1), _STRIP, "right")))
        most = int(reached[high - 1])
        with np.errstate(over="ignore", invalid="ignore"):
            scores = user_rows[low:high] @ item_rows[:most].T
        here = slice(*np.searchsorted(at_user, [low, low + len(scores)]))
        r, i = at_user[here] - low, at_item[here]
        scores[r[i < most], i[i < most]] = -np.inf
        scores[~(scores < bound)] = -np.inf                  # NaN as well
        cut = least[low:low + len(scores)].copy()
        free = np.nonzero(cut == -np.inf)[0]
        if len(free) and n < most:
            cut[free] = np.partition(scores[free], -n, axis=1)[:, -n]
        row, col = np.nonzero((scores >= cut[:, None]) & (scores > -np.inf))
        score, item = scores[row, col], items[col]
        passes = (score > least[low + row]) | (item < last[low + row])
        row, score, item = row[passes], score[passes], item[passes]
        order = np.lexsort((item, -score, row))
        row, score, item = row[order], score[order], item[order]
        first = np.searchsorted(row, row)                    # where the row of each begins
        best = np.arange(len(row)) - first < n
        out.append((users[low + row[best]], item[best], score[best]))
        low = high
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def _cell_lists(n: int, bound: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, kind = left.column("id").to_numpy(), left.column("kind").to_numpy()
        if kind.min(initial=1) == 1 or kind.max(initial=0) == 0:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            rows = _matrix(left.column("features"))
            users, items = kind == 0, kind == 1
            floor = left.column("floor").to_numpy()[users], left.column("last").to_numpy()[users]
            user, item = right.column("user").to_numpy(), right.column("item").to_numpy()
            known = np.isin(user, ids[users]) & np.isin(item, ids[items])
            found = best_of_cell(ids[users], rows[users], floor, ids[items], rows[items], (user[known], item[known]), n, bound)
        return pa.table({"user_id": pa.array(found[0], pa.int64()), "item_id": pa.array(found[1], pa.int64()),
                         "prediction": pa.array(found[2], pa.float64())})
    return run


def _with_length(rows: DataFrame, name: str) -> DataFrame:
    rows = rows.select(F.col(name).cast("bigint").alias("id"), F.col("features").cast("array<double>").alias("features"))
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x))
    return rows.withColumn("length", F.when(length < float("inf"), length).otherwise(float("inf")))


def _turns(items: DataFrame, n_items: int, first: int):
    """Which turn an item is of: the ``first`` longest or so, then ``GROWTH`` times as many as before, and so on."""
    sizes = []
    while sum(sizes) + (sizes[-1] * GROWTH if sizes else first) < n_items:
        sizes.append(sum(sizes) * GROWTH or first)
    shares = [1 - sum(sizes[:at + 1]) / n_items for at in range(len(sizes))]
    cuts = items.approxQuantile("length", shares, 0.001) if shares else []
    return sum((F.when(F.col("length") < cut, 1).otherwise(0) for cut in cuts), F.lit(0))


def top_unrated(users: DataFrame, items: DataFrame, rated: DataFrame, n: int = 50, bound: float = 1000.0,
                block: int = BLOCK) -> DataFrame:
    """(user_id, rank, item_id, prediction): each user's best ``n`` items by the product of their factors.

    ``users`` is (user_id, features), ``items`` (item_id, features), one row per id and of one length; ``rated``
    holds the (user_id, item_id) pairs to leave out.  Scores that are no number below ``bound`` are not listed;
    equal scores are ranked by item id.  Users with nothing to list have no row.
    """
    users, items = pinned(_with_length(users, "user_id")), pinned(_with_length(items, "item_id"))
    n_users, n_items = users.count(), items.count()
    items = items.withColumn("turn", _turns(items, n_items, block))
    turns = sorted(items.groupBy("turn").agg(F.count(F.lit(1)).alias("size"), F.max("length").alias("longest")).collect()) or [(0, 0, 0.0)]
    tasks = 2 * users.sparkSession.sparkContext.defaultParallelism
    pairs = rated.select(F.col("user_id").cast("bigint").alias("user"), F.col("item_id").cast("bigint").alias("item")).dropna().distinct()
    pairs = pairs.join(items.select(F.col("id").alias("item"), "turn"), "item")
    if len(turns) > 1:
        pairs = pinned(pairs)
    best_first = Window.partitionBy("user_id").orderBy(F.col("prediction").desc(), "item_id")

    def cell(name, cells):
        return F.expr(f"pmod(xxhash64({name}), {cells})")

    def every(cells):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint")))

    best = None
    for at, (turn, size, longest) in enumerate(turns):
        item_cells = max(1, -(-size // block))
        user_cells = max(1, -(-n_users // block), min(-(-n_users // _LEAST), -(-tasks // item_cells)))
        live = users.withColumn("floor", F.lit(float("-inf"))).withColumn("last", F.lit(0).cast("bigint"))
        if best is not None:
            floors = best.where(F.col("rank") == n).select(F.col("user_id").alias("id"), F.col("prediction").alias("floor"), F.col("item_id").alias("last"))
            live = (users.join(floors, "id", "left").where(F.col("floor").isNull() | (F.col("floor") <= 0) | ~(F.col("length") * longest * _SLACK < F.col("floor")))
                    .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))).withColumn("last", F.coalesce("last", F.lit(0).cast("bigint"))))
        here = items.where(F.col("turn") == turn)
        sides = (live.select(cell("id", user_cells).alias("u"), every(item_cells).alias("i"), F.lit(0).alias("kind"), "id", "features", "floor", "last")
                 .unionAll(here.select(every(user_cells).alias("u"), cell("id", item_cells).alias("i"), F.lit(1).alias("kind"), "id", "features",
                                       F.lit(0.0).alias("floor"), F.lit(0).cast("bigint").alias("last"))))
        out = pairs.where(F.col("turn") == turn).select(cell("user", user_cells).alias("u"), cell("item", item_cells).alias("i"), "user", "item")
        lists = sides.groupBy("u", "i").cogroup(out.groupBy("u", "i")).applyInArrow(_cell_lists(n, bound), "user_id bigint, item_id bigint, prediction double")
        if best is not None:
            lists = best.select("user_id", "item_id", "prediction").unionAll(lists)
        best = lists.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)
        if at < len(turns) - 1:
            best = pinned(best)
    return best.select("user_id", "rank", "item_id", "prediction")


def recommend_for_all(model, rated: DataFrame, items: DataFrame, n: int = 50, block: int = BLOCK) -> DataFrame:
    """(user_id, rank, item_id, name, prediction) of an ALS model's users, over the catalogue items that it knows."""
    catalogue = items.select("item_id", "name")
    known = (model.itemFactors.withColumnRenamed("id", "item_id").join(catalogue.select("item_id"), "item_id", "left_semi"))
    top = top_unrated(model.userFactors.withColumnRenamed("id", "user_id"), known, rated, n, block=block)
    return top.join(catalogue, "item_id").select("user_id", "rank", "item_id", "name", "prediction")
