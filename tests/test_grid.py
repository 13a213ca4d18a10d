"""Grid search: what it reads, stores and picks."""

import os
import random
import threading

import duckdb
import pytest
from pyspark.sql import functions as F

from applens.operators import ratings as rt, recommend

GRID = {"rank": [2, 3], "reg": [0.05, 5.0], "iters": [2, 4]}


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(11)
    rows = [(u, i, float(rng.randint(1, 5)), 1000 + rng.randrange(10)) for u in range(25) for i in range(20) if rng.random() < 0.6]
    rows += [(500, 1, 3.0, 1007), (1, 600, 4.0, 1007), (1, 601, 4.0, 1009)]        # never trained on
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double, ts bigint").withColumn("bucket", F.col("ts") % 10)


def test_errors_are_those_of_the_stored_predictions(spark, ratings, tmp_dir):
    with recommend.held(ratings, 4) as kept:
        training, validation, test = rt.split_three_way(kept)
        res = recommend.grid_search(training, validation, GRID, all_rows_denominator=True, keep=f"{tmp_dir}/kept", cache=False, blocks=4)
        test_rmse = recommend.rmse_over_all(res.model, test)
        res.model.transform(test).write.parquet(f"{tmp_dir}/test")
        n_validation = validation.count()
    sql = "sqrt(sum(CASE WHEN NOT isnan(prediction) THEN (rating - prediction) ** 2 END) / count(*))"
    stored = duckdb.query(f"SELECT trial, {sql}, count(*), count(*) FILTER (WHERE isnan(prediction)) "
                          f"FROM read_parquet('{tmp_dir}/kept/*/*.parquet', hive_partitioning = true) GROUP BY trial ORDER BY trial").fetchall()
    assert [t[:3] for t in res.trials] == [(k, r, i) for k in GRID["rank"] for r in GRID["reg"] for i in GRID["iters"]]
    assert [round(s[1], 9) for s in stored] == [round(t[3], 9) for t in res.trials]
    assert {s[2] for s in stored} == {n_validation} and all(s[3] >= 2 for s in stored)
    least = min(range(8), key=lambda at: (res.trials[at][3], at))
    assert res.trials[least] == (res.rank, res.reg, res.iters, res.rmse)
    assert duckdb.query(f"SELECT {sql} FROM '{tmp_dir}/test/*.parquet'").fetchall()[0][0] == pytest.approx(test_rmse, abs=1e-9)
    # with scored rows alone as denominator the stored rows give the larger error
    other = recommend.grid_search(*rt.split_three_way(ratings)[:2], {k: v[:1] for k, v in GRID.items()}, keep=f"{tmp_dir}/again", blocks=4)
    assert other.rmse > res.trials[0][3]


def test_a_grid_of_twelve_fits_parses_its_input_once(spark, ratings):
    n, parsed = ratings.count(), spark.sparkContext.accumulator(0)

    @F.udf("double")
    def parse(x):
        parsed.add(1)
        return x

    source = ratings.withColumn("rating", parse("rating"))
    with recommend.held(source, 4) as kept:
        training, validation = rt.split_two_way(kept)
        recommend.grid_search(training, validation, {"rank": [2, 3], "reg": [0.01, 0.1, 10.0], "iters": [1, 2]}, cache=False, parallelism=2, blocks=4)
        assert kept.rdd.getNumPartitions() == 4
        assert kept.storageLevel.useMemory
    assert parsed.value == n
    assert not kept.storageLevel.useMemory


def test_the_item_bias_baseline(spark):
    rows = [(1, 1, 4.0), (2, 1, 2.0), (1, 2, 5.0), (3, 2, 5.0)]
    model = recommend.fit_item_bias(spark.createDataFrame(rows, "user_id int, item_id int, rating double"), rank=2, reg=1.0, max_iter=1)
    got = model.transform(spark.createDataFrame([(1,), (2,), (3,)], "item_id int")).collect()
    want = {1: 4 + (6 - 8) / 4 / 2, 2: 4 + (10 - 8) / 4 / 2}
    assert {r["item_id"]: r["prediction"] for r in got if r["item_id"] < 3} == want
    assert [r["prediction"] != r["prediction"] for r in got if r["item_id"] == 3] == [True]


def test_a_saved_model_scores_as_before(spark, ratings, tmp_dir):
    training, validation = rt.split_two_way(ratings)
    model = recommend.fit(training, rank=3, reg=0.1, max_iter=3)
    model.write().save(f"{tmp_dir}/model")
    assert sorted(os.listdir(f"{tmp_dir}/model")) == ["itemFactors", "metadata", "userFactors"]
    again = recommend.ALSModel.load(f"{tmp_dir}/model")
    a, b = (recommend.score(m, validation).select("user_id", "item_id", "rating", "prediction") for m in (model, again))
    assert 0 < a.count() < validation.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_no_fit_waits_for_a_longer_one_beside_it(spark, ratings):
    training, validation = rt.split_two_way(ratings)
    started, last = [], threading.Event()

    def trainer(t, **kw):
        started.append((kw["rank"], kw["max_iter"]))
        if len(started) == 6:
            last.set()
        if started[0] == (kw["rank"], kw["max_iter"]):
            assert last.wait(60), "the others wait for the first"
        return recommend.fit_item_bias(t, reg=0.1 * kw["rank"])

    res = recommend.grid_search(training, validation, {"rank": [3, 2], "reg": [0.1], "iters": [1, 4, 2]}, parallelism=2, trainer=trainer)
    assert {i for _, i in started[:2]} == {4}                      # longest first
    assert [t[:3] for t in res.trials] == [(k, 0.1, i) for k in (3, 2) for i in (1, 4, 2)]
    errors = [t[3] for t in res.trials]
    assert len(set(errors[:3])) == 1 == len(set(errors[3:])) and errors[0] != errors[3]
    least = errors.index(min(errors))                              # equal errors: the first in grid order wins, whichever ended first
    assert (res.rank, res.reg, res.iters, res.rmse) == (*res.trials[least][:3], min(errors))


def test_scored_rows_stay_where_they_are(spark, ratings, monkeypatch, tmp_dir):
    training, validation = rt.split_two_way(ratings)
    plans, models, real = [], [], recommend.ALSModel.transform

    def transform(model, data):
        out = real(model, data)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        models.append(model)
        return out

    model = recommend.fit(training, rank=2, max_iter=2)
    want = sorted(map(tuple, model.transform(validation).select("user_id", "item_id", "prediction").fillna(-1).collect()))
    monkeypatch.setattr(recommend.ALSModel, "transform", transform)
    res = recommend.grid_search(training, validation, {"rank": [2], "reg": [0.01], "iters": [2]}, keep=f"{tmp_dir}/kept", cache=False)
    recommend.grid_search(training, validation, {"rank": [2], "reg": [0.01], "iters": [2]}, cache=False)
    recommend.rmse_over_all(res.model, validation)
    assert len(plans) == 3 and all(p.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in p for p in plans)
    got = spark.read.parquet(f"{tmp_dir}/kept/trial=0").select("user_id", "item_id", "prediction").fillna(-1).collect()
    assert sorted(map(tuple, got)) == want
    assert not any(side.storageLevel.useMemory for m in models for side in (m.userFactors, m.itemFactors))
