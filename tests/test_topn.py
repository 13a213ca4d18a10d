"""All-user top-N by blocks, against scoring every pair."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from applens.operators import recommend, topn


def everything(users, items, rated, n, bound=1000.0):
    out = []
    for u, x in users:
        scored = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in items if (u, i) not in rated]
        scored = sorted((s, i) for s, i in scored if -s < bound)
        out += [(u, r + 1, i, float(-s)) for r, (s, i) in enumerate(scored[:n])]
    return sorted(out)


@pytest.fixture(scope="module")
def factors():
    rng = random.Random(1)
    users = [(u * 3 - 20, [rng.randint(-3, 3) for _ in range(4)]) for u in range(40)]
    items = [(i, [rng.randint(-3, 3) for _ in range(4)]) for i in rng.sample(range(1, 500), 70)]
    rated = {(rng.choice(users)[0], rng.choice(items)[0]) for _ in range(400)}
    rated |= {(users[5][0], i) for i, _ in items}                  # one who has rated everything
    return users, items, rated


def frames(spark, factors):
    users, items, rated = factors
    pairs = [*rated, *rated, (999, 1), (users[0][0], 9999), (None, 1), (1, None)]
    return (spark.createDataFrame(users, "user_id int, features array<int>"), spark.createDataFrame(items, "item_id int, features array<int>"),
            spark.createDataFrame(pairs, "user_id int, item_id int"))


@pytest.mark.parametrize("block,n", [(4096, 10), (7, 10), (16, 1), (25, 500)])
def test_blocks_do_not_matter(spark, factors, block, n):
    got = topn.top_unrated(*frames(spark, factors), n=n, block=block)
    assert got.columns == ["user_id", "rank", "item_id", "prediction"]
    assert sorted(map(tuple, got.collect())) == everything(*factors, n)


def test_scores_beyond_the_bound_and_no_numbers(spark):
    users = spark.createDataFrame([(1, [1.0]), (2, [float("nan")])], "user_id int, features array<double>")
    items = spark.createDataFrame([(1, [2.0]), (2, [2000.0]), (3, [float("nan")]), (4, [-1.0])], "item_id int, features array<double>")
    none = spark.createDataFrame([], "user_id int, item_id int")
    assert sorted(map(tuple, topn.top_unrated(users, items, none).collect())) == [(1, 1, 1, 2.0), (1, 2, 4, -1.0)]
    assert topn.top_unrated(users, items.limit(0), none).count() == 0
    assert topn.top_unrated(users.limit(0), items, none).count() == 0


def test_the_plan_merges_lists_of_bounded_length(spark, factors):
    plan = topn.top_unrated(*frames(spark, factors), n=5, block=16)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_model_lists_for_every_user_what_it_lists_for_one(spark):
    rng = random.Random(4)
    data = [(u, i, float(rng.randint(1, 5))) for u in range(20) for i in range(25) if rng.random() < 0.5]
    ratings = spark.createDataFrame(data, "user_id int, item_id int, rating double")
    model = recommend.fit(ratings, rank=4, reg=0.05, max_iter=5)
    items = spark.createDataFrame([(i, f"item {i}") for i in range(30)], "item_id int, name string")
    top = topn.recommend_for_all(model, ratings, items, n=6, block=8)
    for user in (0, 7, 19):
        one = recommend.top_n(recommend.score_for_user(model, user, recommend.unrated_candidates(items, ratings, user)), items, 6)
        want = [(r["rank"], r["item_id"], r["name"], round(r["prediction"], 9)) for r in one.collect()]
        got = top.where(F.col("user_id") == user).orderBy("rank").collect()
        assert [(r["rank"], r["item_id"], r["name"], round(r["prediction"], 9)) for r in got] == want


def test_lists_do_not_grow_with_the_number_of_cells(spark, monkeypatch):
    rng = random.Random(9)
    users = [(u, [rng.randint(-9, 9) for _ in range(4)]) for u in range(60)]
    items = [(i, [rng.randint(-9, 9) for _ in range(4)]) for i in range(2000)]
    rated = {(rng.randrange(60), rng.randrange(2000)) for _ in range(3000)}
    listed, real = spark.sparkContext.accumulator(0), topn.best_of_cell

    def counted(*args):
        out = real(*args)
        listed.add(len(out[0]))
        return out

    monkeypatch.setattr(topn, "best_of_cell", counted)
    got = topn.top_unrated(*frames(spark, (users, items, rated)), n=5, block=50)
    assert sorted(map(tuple, got.collect())) == everything(users, items, rated, 5)
    assert listed.value < 60 * 5 * 8          # 40 cells of items a user, of which each listed 5


def test_a_cell_keeps_what_comes_before_the_floor():
    rng = np.random.default_rng(3)
    for _ in range(40):
        users, items = rng.permutation(50)[:12], rng.permutation(90)[:30]
        x, y = rng.integers(-3, 4, (12, 3)).astype(float), rng.integers(-3, 4, (30, 3)).astype(float)
        floor = rng.choice([-np.inf, -2.0, 0.0, 3.0, 9.0], 12), rng.integers(0, 90, 12)
        rated = {(users[rng.integers(12)], items[rng.integers(30)]) for _ in range(40)}
        got = topn.best_of_cell(users, x, floor, items, y, tuple(map(np.array, zip(*rated))), 4, 8.0)
        want = []
        for u, a, f, last in zip(users, x, *floor):
            scored = sorted((-(a @ b), i) for i, b in zip(items, y) if (u, i) not in rated and a @ b < 8.0)
            want += [(u, i, -s) for s, i in [z for z in scored if z < (-f, last)][:4]]
        assert sorted(zip(*got)) == sorted(want)
