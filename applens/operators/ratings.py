"""Rating splits, unions and error metrics.

Splits are deterministic: the last decimal digit of the rating timestamp
(``bucket``) decides the side, so every run and every engine sees the same
sets (no ``randomSplit``).  Metrics are single aggregates with partial
(map-side) aggregation; nothing is collected to the driver but the final
scalars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.sources.tables import read_table

TRAINING, VALIDATION, TEST = "training", "validation", "test"


def with_bucket(r: DataFrame) -> DataFrame:
    return r if "bucket" in r.columns else r.withColumn("bucket", F.col("ts") % 10)


def split_label_three_way(bucket="bucket"):
    b = F.col(bucket)
    return (F.when(b < 6, F.lit(TRAINING)).when(b < 8, F.lit(VALIDATION))
            .otherwise(F.lit(TEST)))


def split_label_two_way(bucket="bucket"):
    return F.when(F.col(bucket) < 8, F.lit(TRAINING)).otherwise(F.lit(VALIDATION))


def split_three_way(r: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """60/20/20 by last digit: ``<6`` / ``6..7`` / ``>=8``."""
    r = with_bucket(r)
    return (r.where(F.col("bucket") < 6), r.where((F.col("bucket") >= 6) & (F.col("bucket") < 8)),
            r.where(F.col("bucket") >= 8))


def split_two_way(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """80/20 by last digit: ``<8`` / ``>=8``."""
    r = with_bucket(r)
    return r.where(F.col("bucket") < 8), r.where(F.col("bucket") >= 8)


def split_counts(r: DataFrame) -> DataFrame:
    """All split sizes in one pass (``count_if`` per side)."""
    b = F.col("bucket")
    return with_bucket(r).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_if(b < 6).alias("n_training"),
        F.count_if((b >= 6) & (b < 8)).alias("n_validation"),
        F.count_if(b >= 8).alias("n_test"),
        F.count_if(b < 8).alias("n_training_80"),
        F.count_if(b >= 8).alias("n_validation_20"))


def rating_profile(r: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of ratings, distinct users and distinct items in one aggregate.

    ``approx=True`` uses HyperLogLog++ sketches (one fixed-size state per
    task, no shuffle of the ids) instead of exact distinct counts.
    """
    if approx:
        distinct = lambda c: F.approx_count_distinct(c, rsd)
    else:
        distinct = F.count_distinct
    return r.agg(F.count(F.lit(1)).alias("n_ratings"),
                 distinct("user_id").alias("n_users"),
                 distinct("item_id").alias("n_items"))


def personal(r: DataFrame, user_id: int = 0) -> DataFrame:
    """One person's own ratings, keeping only real ratings (> 0)."""
    return r.where((F.col("user_id") == user_id) & (F.col("rating") > 0))


def union_training(training: DataFrame, extra: DataFrame) -> DataFrame:
    """Bag union (duplicates kept) by column name."""
    cols = ["user_id", "item_id", "rating"]
    return training.select(*cols).unionByName(extra.select(*cols))


# -- a deterministic reference predictor: the item's mean training rating ---

def item_mean_model(training: DataFrame) -> DataFrame:
    return training.groupBy("item_id").agg(F.avg("rating").alias("prediction"))


def predict(model: DataFrame, pairs: DataFrame) -> DataFrame:
    """Score (user, item) pairs; items the model never saw get NaN, like an
    ALS model without a cold-start strategy."""
    return (pairs.join(model, "item_id", "left")
            .withColumn("prediction", F.coalesce(F.col("prediction"), F.lit(float("nan")))))


def actual_vs_predicted(model: DataFrame, data: DataFrame) -> DataFrame:
    """Actual ratings next to the predictions of their items; rows whose item has none are left out.

    One join: a pair rated k times gives k rows.
    """
    return data.join(model, "item_id")


def guard_predictions(scored: DataFrame, bound: float = 1000.0) -> DataFrame:
    """Keep usable predictions (drops NaN, which sorts above every number)."""
    return scored.where(F.col("prediction") < bound)


def squared_error():
    return (F.col("rating") - F.col("prediction")) * (F.col("rating") - F.col("prediction"))


def mse(joined: DataFrame) -> DataFrame:
    return joined.agg(F.avg(squared_error()).alias("mse"), F.count(F.lit(1)).alias("n_pairs"))


def rmse_all_rows(model: DataFrame, data: DataFrame) -> DataFrame:
    """sqrt(sum of squared errors over predicted rows / number of ALL rows).

    One left join and one aggregate: rows without a prediction still count in
    the denominator, as in the reference's hold-out score.  NULL when nothing was scored.
    """
    e2 = F.when(F.col("prediction").isNotNull(), squared_error())
    return data.join(model, "item_id", "left").agg(
        F.sqrt(F.try_divide(F.sum(e2), F.count(F.lit(1)))).alias("rmse"),
        F.count("prediction").alias("n_predicted"), F.count(F.lit(1)).alias("n_rows"))


def rmse_predicted_rows(joined: DataFrame) -> DataFrame:
    """sqrt(mean squared error) over the rows that got a prediction."""
    return joined.agg(F.sqrt(F.avg(squared_error())).alias("rmse"),
                      F.count(F.lit(1)).alias("n_predicted"))


def mean_baseline(r: DataFrame, model: DataFrame) -> DataFrame:
    """Constant-mean baseline against the model on the test split.

    mean = avg rating of training+validation; baseline RMSE = RMSE of always
    predicting it on test; model RMSE uses all test rows as denominator and is NULL when none was
    scored; the improvement is in percent.  Everything comes out of one
    aggregate over the ratings left-joined to the model: the baseline's mean squared error is
    the test ratings' variance plus the squared distance of the two means, which needs no second pass
    and does not cancel.
    """
    r = with_bucket(r)
    scored = r.join(model, "item_id", "left")
    b, x = F.col("bucket"), F.col("rating")
    fit = b < 8
    test = b >= 8
    agg = scored.agg(
        F.avg(F.when(fit, x)).alias("mean_rating"),
        F.avg(F.when(test, x)).alias("test_mean"),
        F.var_pop(F.when(test, x)).alias("test_var"),
        F.count_if(test).alias("n_test"),
        F.sum(F.when(test & F.col("prediction").isNotNull(), squared_error())).alias("sse"))
    m, n = F.col("mean_rating"), F.col("n_test")
    baseline = F.sqrt(F.col("test_var") + (F.col("test_mean") - m) * (F.col("test_mean") - m))
    model_rmse = F.sqrt(F.try_divide(F.col("sse"), n))
    return agg.select(m.alias("mean_rating"), baseline.alias("baseline_rmse"),
                      model_rmse.alias("model_rmse"),
                      (F.try_divide(baseline - model_rmse, baseline) * 100).alias("improvement_pct"),
                      n.alias("n_test"))


# -- daily rating table (device, app, rating, last time; year/month/day) -----

RATING_TABLE_DDL = ("imei STRING, pkg STRING, rating DOUBLE, lasttimestamp BIGINT, "
                    "year STRING, month STRING, day STRING")


def write_rating_table(df: DataFrame, path: str) -> None:
    (df.hint("rebalance", "year", "month", "day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day").parquet(path))


def read_rating_day(spark: SparkSession, source: str, year: str, month: str, day: str) -> DataFrame:
    """One day of the table (a path or a catalogue name), renamed to (user, app, rating, lasttimestamp).

    The schema keeps partition values as strings, and the predicate on them
    prunes the scan to that day's directory.
    """
    t = read_table(spark, source, RATING_TABLE_DDL)
    return (t.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
            .select(F.col("imei").alias("user"), F.col("pkg").alias("app"), "rating", "lasttimestamp"))
