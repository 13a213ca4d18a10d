"""Collaborative filtering with ``pyspark.ml`` ALS.

Grid search runs on a fixed split (not k-fold): every (rank, regParam,
maxIter) fits on training and is scored on validation; the first strictly
better RMSE wins ties.  Scoring, ranking and top-N all stay distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Grids of the two tuning jobs (fixed values).
GRID_THREE_WAY = {"rank": [8, 12], "reg": [0.01, 0.02, 0.1, 10.0], "iters": [10, 20]}
GRID_TWO_WAY = {"rank": [8, 12], "reg": [0.01, 0.1, 10.0], "iters": [10, 20]}

MAX_TOP = 10_000
BLOCK_IDS = 64               # ids of a side, and its ratings, that a block of a fit takes before there are more blocks
BLOCK_RATINGS = 8_000_000


def make_als(rank: int = 10, max_iter: int = 10, reg: float = 0.01, seed: int = 42,
             user_col: str = "user_id", item_col: str = "item_id",
             rating_col: str = "rating", blocks: int | tuple[int, int] | None = None) -> ALS:
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol=user_col,
              itemCol=item_col, ratingCol=rating_col, coldStartStrategy="nan",
              checkpointInterval=10)
    if blocks:
        users, items = blocks if isinstance(blocks, tuple) else (blocks, blocks)
        als = als.setNumUserBlocks(users).setNumItemBlocks(items)
    return als


def default_blocks(training: DataFrame) -> int:
    """Blocks for as many tasks as the session runs at once (at least ALS's own 10)."""
    return max(10, training.sparkSession.sparkContext.defaultParallelism)


def side_blocks(training: DataFrame, most: int | None = None) -> tuple[int, int]:
    """(user blocks, item blocks) of a fit, at most ``most`` (see :func:`default_blocks`).

    Each iteration sends every user's factors to all item blocks that hold one of its items, and the other way round, so
    a side of few ids gets no more blocks than its ids and ratings need.
    """
    most = most or default_blocks(training)
    n, users, items = training.agg(F.count(F.lit(1)), F.approx_count_distinct("user_id"), F.approx_count_distinct("item_id")).first()
    return tuple(min(most, max(1, -(-ids // BLOCK_IDS), -(-n // BLOCK_RATINGS))) for ids in (users, items))


def fit(training: DataFrame, blocks: int | tuple[int, int] | None = None, **kw) -> ALSModel:
    """Fit ALS over ``blocks`` user and item blocks (see :func:`side_blocks`).

    Its factor lineage is checkpointed every 10 iterations into
    the shared checkpoint folder, so a lost executor costs at most the
    iterations since the last checkpoint instead of the whole fit."""
    from applens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(training.sparkSession)
    return make_als(blocks=blocks or side_blocks(training), **kw).fit(training)


def score(model: ALSModel, data: DataFrame, bound: float = 1000.0) -> DataFrame:
    """Predictions for the rows of ``data`` (NaN for unseen users/items is
    dropped by the ``< bound`` guard)."""
    return model.transform(data).where(F.col("prediction") < bound)


def _squared_error():
    return (F.col("rating") - F.col("prediction")) ** 2


def rmse(predictions: DataFrame) -> float | None:
    """RMSE of scored rows; None if there are none."""
    mean = predictions.agg(F.avg(_squared_error())).first()[0]
    return None if mean is None else float(mean) ** 0.5


def _rmse_of_all(scored: DataFrame) -> float | None:
    row = (scored.agg(F.sum(F.when(~F.isnan("prediction"), _squared_error())).alias("sse"),
                      F.count(F.lit(1)).alias("n")).first())
    return None if row["sse"] is None else float((row["sse"] / row["n"]) ** 0.5)


def rmse_over_all(model, data: DataFrame) -> float | None:
    """RMSE with the number of ALL rows as denominator (unscored rows count); None if none was scored."""
    with sized(model):
        return _rmse_of_all(model.transform(data))


@contextmanager
def sized(model) -> Iterator[None]:
    """Inside the block the planner knows how large the factors of ``model`` are.

    What a fit returns has no size, so each scoring join would shuffle the rows to be scored; of factors that are counted
    and kept, the joins broadcast a side that is below the session's threshold and leave the rows where they are.
    """
    sides = [model.userFactors, model.itemFactors] if isinstance(model, ALSModel) else []
    try:
        for side in sides:
            side.persist(StorageLevel.MEMORY_AND_DISK).count()
        yield
    finally:
        for side in sides:
            side.unpersist()


@dataclass
class ItemBias:
    """The mean rating plus an offset per item; items it never saw get NaN, as from an ALS model."""

    offsets: DataFrame

    def transform(self, data: DataFrame) -> DataFrame:
        return (data.join(self.offsets, "item_id", "left")
                .withColumn("prediction", F.coalesce("prediction", F.lit(float("nan")))))


def fit_item_bias(training: DataFrame, rank: int = 1, reg: float = 0.0, max_iter: int = 10, **_) -> ItemBias:
    """A baseline with the settings of an ALS fit: an item's offset is the sum of its deviations over its
    count plus ``reg * rank``, approached from 0 by ``max_iter`` half steps.  One aggregate; only the mean
    reaches the driver."""
    mean = training.agg(F.avg("rating")).first()[0]
    near = 1 - 0.5 ** max_iter
    offset = F.sum(F.col("rating") - F.lit(mean)) / (F.count(F.lit(1)) + F.lit(reg * rank)) * near
    return ItemBias(training.groupBy("item_id").agg((F.lit(mean) + offset).alias("prediction")))


@contextmanager
def held(ratings: DataFrame, blocks: int | None = None) -> Iterator[DataFrame]:
    """``ratings`` read once and kept, dealt by user to as many blocks as a fit uses, and released at the end.

    Splits of it are filters over what is kept, so a search reads and parses its input once
    however many settings it tries.
    """
    kept = ratings.repartition(blocks or default_blocks(ratings), "user_id").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


@dataclass
class GridResult:
    model: ALSModel
    rank: int
    reg: float
    iters: int
    rmse: float
    trials: list


def grid_search(training: DataFrame, validation: DataFrame, grid: dict,
                all_rows_denominator: bool = False, seed: int = 42,
                parallelism: int = 1, blocks: int | None = None, trainer: Callable | None = None,
                keep: str | None = None, cache: bool = True) -> GridResult:
    """rank -> regParam -> maxIter order; first strictly smaller RMSE wins.

    ``parallelism`` > 1 keeps that many fits running from driver threads
    (each fit is its own distributed job; a large cluster runs them side by
    side), those of most iterations first, so that none waits for a longer one beside it; the winner
    is still the first in grid order.  Only the best model so far is
    kept: Spark releases the factors of the others once nothing refers to them.
    Inputs are cached for the search and released after, unless ``cache`` is off because they are parts of
    what :func:`held` keeps.  A setting that scored nothing never wins; raises if no
    setting produced a finite RMSE (e.g. no overlap between the splits) instead of returning nothing.

    ``trainer`` replaces :func:`fit`; it takes the same settings and returns something with ``transform``.
    With ``keep``, every setting's validation rows are stored with their predictions under
    ``<keep>/trial=<place>`` and the error is that of the stored rows, which are not scored again.
    """
    from concurrent.futures import ThreadPoolExecutor

    settings = [(rank, reg, iters) for rank in grid["rank"] for reg in grid["reg"]
                for iters in grid["iters"]]
    if cache:
        training, validation = training.cache(), validation.cache()
    if not blocks and not trainer:
        blocks = side_blocks(training)

    best, winner, lock = None, None, Lock()

    def run(place):
        nonlocal best, winner
        rank, reg, iters = settings[place]
        model = (trainer or fit)(training, rank=rank, reg=reg, max_iter=iters, seed=seed, blocks=blocks)
        with sized(model):
            if keep:
                at = f"{keep}/trial={place}"
                model.transform(validation).select("user_id", "item_id", "rating", "prediction").write.mode("overwrite").parquet(at)
                stored = training.sparkSession.read.parquet(at)
                r = _rmse_of_all(stored) if all_rows_denominator else rmse(stored.where(F.col("prediction") < 1000.0))
            else:
                r = _rmse_of_all(model.transform(validation)) if all_rows_denominator else rmse(score(model, validation))
        with lock:
            if r is not None and r == r and (best is None or (r, place) < (best.rmse, winner)):
                best, winner = GridResult(model, rank, reg, iters, r, []), place
        return r

    order = sorted(range(len(settings)), key=lambda place: -settings[place][2] if parallelism > 1 else place)
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            errors = dict(zip(order, pool.map(run, order)))
        if best is None:
            raise ValueError("no grid setting produced a finite validation RMSE")
        best.trials = [(*setting, errors[place]) for place, setting in enumerate(settings)]
        return best
    finally:
        if cache:
            training.unpersist()
            validation.unpersist()


def score_for_user(model: ALSModel, user_id: int, items: DataFrame, bound: float = 1000.0) -> DataFrame:
    """(item_id, prediction) of one user for ``items`` (item_id) that the model knows; empty for an unknown user.

    The user's factors are one row of ``rank`` numbers; they become a literal, and each item's
    score is its dot product with them: a scan of the item factors and an equi-join with the items.
    """
    row = model.userFactors.where(F.col("id") == user_id).first()
    known = model.itemFactors if row else model.itemFactors.limit(0)
    mine = F.array(*[F.lit(float(x)) for x in (row["features"] if row else [])]).cast("array<double>")
    dot = F.aggregate(F.zip_with("features", mine, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    return (known.select(F.col("id").alias("item_id"), dot.alias("prediction"))
            .join(items.select("item_id").distinct(), "item_id").where(F.col("prediction") < bound))


def unrated_candidates(items: DataFrame, rated: DataFrame, user_id: int) -> DataFrame:
    """(user, item) for every catalogue item the user has not rated."""
    seen = rated.where(F.col("user_id") == user_id).select("item_id")
    return (items.select("item_id").distinct().join(seen, "item_id", "left_anti")
            .withColumn("user_id", F.lit(user_id).cast("int")))


def top_n(scored: DataFrame, items: DataFrame, n: int = 50,
          score_col: str = "prediction") -> DataFrame:
    """Best ``n`` scored candidates with names and a ``%2d: name`` listing.

    ``orderBy(...).limit(n)`` plans as a distributed top-k (each task keeps
    ``n`` rows); naming and numbering happen on those ``n`` rows only, in one task: ``n`` is a
    list for a person to read, at most MAX_TOP.
    """
    if n > MAX_TOP:
        raise ValueError(f"top_n lists at most {MAX_TOP} items; sort the scores instead")
    top = (scored.where(~F.isnan(score_col) & F.col(score_col).isNotNull())
           .orderBy(F.col(score_col).desc(), F.col("item_id").asc()).limit(n))
    # The <= n chosen rows are broadcast (bounded by the limit) and the item
    # dimension streams past them once: no shuffle of the dimension.
    # Candidates come from the dimension, so every chosen item has its row.
    named = items.select("item_id", "name").join(F.broadcast(top), "item_id")
    # number the <= n rows: one sorted array of at most n entries, exploded
    # with its positions (no window, no single-partition sort of the input)
    order = F.struct((-F.col(score_col)).alias("_k"), F.col("item_id").alias("item_id"),
                     F.col("name").alias("name"), F.col(score_col).alias(score_col))
    ranked = (named.agg(F.sort_array(F.collect_list(order)).alias("_top"))
              .select(F.posexplode("_top").alias("_pos", "_e")))
    return ranked.select((F.col("_pos") + 1).cast("int").alias("rank"), F.col("_e.item_id").alias("item_id"),
                         F.col("_e.name").alias("name"), F.col(f"_e.{score_col}").alias(score_col),
                         F.format_string("%2d: %s", F.col("_pos") + 1, F.col("_e.name")).alias("listing"))

