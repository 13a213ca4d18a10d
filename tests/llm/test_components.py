"""Connected components: whatever the session's width, small link tables take few tasks."""

import random

import pytest

from applens.llm import components as cc


@pytest.fixture
def wide(spark):
    """A session that shuffles into 64 partitions and never merges them."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def by_hand(links):
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return sorted((x, find(x)) for x in root)


@pytest.mark.parametrize("per_task", [25_000, 10])
def test_few_links_take_few_tasks_a_round(wide, monkeypatch, per_task):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101 + i) for i in range(150)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    links = [x for x in links if x[0] != x[1]]
    kept, pinned = [], cc.pinned

    def counted(df):
        kept.append(pinned(df))
        return kept[-1]

    monkeypatch.setattr(cc, "pinned", counted)
    monkeypatch.setattr(cc, "TASK_LINKS", per_task)
    out = cc.components(wide.createDataFrame(links * 2, "a long, b long"))
    assert sorted(map(tuple, out.collect())) == by_hand(links)
    tasks = [df.rdd.getNumPartitions() for df in kept[1:]]
    assert len(tasks) > 1 and (max(tasks) <= 8 if per_task > len(links) else 8 < max(tasks) <= 26)
