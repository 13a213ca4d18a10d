"""ALS recommender: quality vs the mean baseline, grid rule, top-N, save/load."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from applens.operators import ratings as rt, recommend


@pytest.fixture(scope="module")
def low_rank(spark):
    rnd = random.Random(3)
    users = [[rnd.gauss(0, 1) for _ in range(2)] for _ in range(40)]
    items = [[rnd.gauss(0, 1) for _ in range(2)] for _ in range(30)]
    data = []
    for u, uf in enumerate(users):
        for i, itf in enumerate(items):
            if rnd.random() < 0.6:
                r = 3 + sum(a * b for a, b in zip(uf, itf))
                data.append((u, i, float(r), 10 * (100 * u + i) + rnd.randrange(10)))
    return spark.createDataFrame(data, "user_id int, item_id int, rating double, ts bigint")


def test_als_beats_mean_baseline(spark, low_rank):
    train, valid = rt.split_two_way(low_rank)
    model = recommend.fit(train, rank=4, reg=0.05, max_iter=15)
    model_rmse = recommend.rmse(recommend.score(model, valid))
    mean = train.agg(F.avg("rating")).first()[0]
    base = valid.agg(F.sqrt(F.avg((F.col("rating") - F.lit(mean)) ** 2))).first()[0]
    assert model_rmse < base
    assert recommend.rmse_over_all(model, valid) >= 0


def test_grid_order_and_first_wins(spark, low_rank, monkeypatch):
    train, valid = rt.split_two_way(low_rank)
    scores = iter([2.0, 1.0, 1.0, 3.0])
    monkeypatch.setattr(recommend, "fit", lambda t, **kw: kw)
    monkeypatch.setattr(recommend, "score", lambda m, d: m)
    monkeypatch.setattr(recommend, "rmse", lambda p: next(scores))
    res = recommend.grid_search(train, valid, {"rank": [8, 12], "reg": [0.1], "iters": [10, 20]})
    assert [(t[0], t[2]) for t in res.trials] == [(8, 10), (8, 20), (12, 10), (12, 20)]
    assert (res.rank, res.iters, res.rmse) == (8, 20, 1.0)


def test_grid_all_nan_raises(spark, low_rank, monkeypatch):
    monkeypatch.setattr(recommend, "fit", lambda t, **kw: kw)
    monkeypatch.setattr(recommend, "score", lambda m, d: m)
    monkeypatch.setattr(recommend, "rmse", lambda p: None)
    with pytest.raises(ValueError):
        recommend.grid_search(low_rank, low_rank, {"rank": [8], "reg": [0.1], "iters": [10]})


def test_top_n_and_save_load(spark, low_rank, tmp_dir):
    model = recommend.fit(low_rank, rank=4, reg=0.05, max_iter=10)
    items = spark.createDataFrame([(i, f"item {i}") for i in range(35)], "item_id int, name string")
    cands = recommend.unrated_candidates(items, low_rank, user_id=0)
    rated0 = {r[0] for r in low_rank.where("user_id = 0").select("item_id").collect()}
    assert {r[0] for r in cands.select("item_id").collect()} == set(range(35)) - rated0
    top = recommend.top_n(model.transform(cands), items, n=5).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert all(top[k]["prediction"] >= top[k + 1]["prediction"] for k in range(4))
    assert top[0]["listing"] == f" 1: {top[0]['name']}"
    model.write().overwrite().save(f"{tmp_dir}/model")
    from pyspark.ml.recommendation import ALSModel
    same = ALSModel.load(f"{tmp_dir}/model")
    a = model.transform(low_rank.limit(20)).select("prediction").collect()
    b = same.transform(low_rank.limit(20)).select("prediction").collect()
    assert a == b


def test_grid_parallel_keeps_grid_order(spark, low_rank, monkeypatch):
    table = {(8, 10): 2.0, (8, 20): 1.0, (12, 10): 1.0, (12, 20): 3.0}
    monkeypatch.setattr(recommend, "fit", lambda t, **kw: kw)
    monkeypatch.setattr(recommend, "score", lambda m, d: m)
    monkeypatch.setattr(recommend, "rmse", lambda p: table[(p["rank"], p["max_iter"])])
    res = recommend.grid_search(low_rank, low_rank, {"rank": [8, 12], "reg": [0.1], "iters": [10, 20]},
                                parallelism=3)
    assert (res.rank, res.iters) == (8, 20)
    assert [t[3] for t in res.trials] == [2.0, 1.0, 1.0, 3.0]


def test_unscored_settings_never_win(spark, low_rank):
    train, valid = rt.split_two_way(low_rank)
    unseen = valid.withColumn("item_id", F.col("item_id") + 1000)
    model = recommend.fit(train, rank=2, max_iter=2)
    assert recommend.rmse_over_all(model, unseen) is None and recommend.rmse(recommend.score(model, unseen)) is None
    with pytest.raises(ValueError):
        recommend.grid_search(train, unseen, {"rank": [2], "reg": [0.1], "iters": [2]}, all_rows_denominator=True)


def test_scores_of_one_user_need_no_nested_loop(spark, low_rank):
    train, _ = rt.split_two_way(low_rank)
    model = recommend.fit(train, rank=3, max_iter=3)
    items = spark.range(30).select(F.col("id").cast("int").alias("item_id"))
    scored = recommend.score_for_user(model, 5, items)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = {r["item_id"]: r["prediction"] for r in model.transform(items.withColumn("user_id", F.lit(5))).collect()}
    got = {r["item_id"]: r["prediction"] for r in scored.collect()}
    assert set(got) == {i for i, p in want.items() if p == p} and all(abs(got[i] - want[i]) < 1e-4 for i in got)
    assert recommend.score_for_user(model, 12345, items).count() == 0


def test_blocks_follow_the_session_or_the_argument(spark, low_rank):
    assert recommend.default_blocks(low_rank) == max(10, spark.sparkContext.defaultParallelism)
    assert recommend.make_als(blocks=33).getNumUserBlocks() == 33


def test_registered_queries_return_what_the_fit_predicts(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    queries = entry.queries()
    top = sorted(map(tuple, queries["als_top_items"](spark, sf).select("rank", "item_id", "name", "prediction").collect()))
    assert [r[0] for r in top] == list(range(1, len(top) + 1)) == sorted(r["rank"] for r in queries["als_top_n"](spark, sf).collect())
    assert top and all(a[3] >= b[3] for a, b in zip(top, top[1:])) and all(r[2] for r in top) and len({r[1] for r in top}) == len(top)
    told = queries["als_predictions"](spark, sf)
    assert all(abs(r["prediction"]) < 1000 for r in told.collect())
    keys = ["user_id", "item_id", "rating"]
    assert sorted(map(tuple, told.select(keys).collect())) == sorted(map(tuple, queries["als_predict"](spark, sf).select(keys).collect()))


def test_a_side_of_few_ids_gets_few_blocks(spark, monkeypatch):
    ratings = spark.range(12_000).selectExpr("CAST(id % 3000 AS INT) AS user_id", "CAST(id % 100 AS INT) AS item_id", "CAST(id % 5 AS DOUBLE) AS rating")
    assert recommend.side_blocks(ratings, 12) == (12, 2)         # users' factors go to 2 blocks of items, not to 12
    assert recommend.side_blocks(ratings.limit(0), 12) == (1, 1)
    made, real = [], recommend.make_als
    monkeypatch.setattr(recommend, "make_als", lambda **kw: made.append(kw["blocks"]) or real(**kw))
    model = recommend.fit(ratings, rank=2, max_iter=1)
    recommend.grid_search(ratings, ratings, {"rank": [2], "reg": [0.1], "iters": [1, 2]})
    assert made == [(10, 2)] * 3 and model.userFactors.count() == 3000 and model.itemFactors.count() == 100
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 2_000)
    assert recommend.side_blocks(ratings, 12) == (12, 6)         # few items of many ratings are still many tasks
