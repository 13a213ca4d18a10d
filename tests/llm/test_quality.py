import random
import zlib

import numpy as np

from applens.llm import quality as q
from llm_fixtures import docs  # noqa: F401  (a fixture)


def make(n=500, seed=1):
    rng = random.Random(seed)
    vocab = ["the", "of", "river", "stone", "walked", "under", "light", "morning", "quiet", "house"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(3, 80))]
        bad = i % 4 == 0
        text = " ".join(w.upper() + "!!" for w in words) if bad and i % 8 else " ".join(w + "###" if bad else w for w in words)
        rows.append((i, text))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def labels_of(spark, labels):
    return spark.createDataFrame([(i, v, 0) for i, v in labels], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_folds(spark, docs):
    rows, labels = make()
    edge = [(10_000, None), (10_001, ""), (10_002, "a"), (10_003, "word " * 50_000), (10_004, " \n")]
    got = {r["doc_id"]: r for r in q.quality_scores(docs(rows + edge, extra=True), labels_of(spark, labels)).collect()}
    assert len(got) == len(rows) + len(edge)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    truth = dict(labels)
    held = [r for i, r in got.items() if r["held_out"] and i in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert got[10_000]["score"] == got[10_001]["score"]


def test_held_out_labels_do_not_matter(spark, docs):
    rows, labels = make(200)
    flipped = [(i, 1 - v if zlib.crc32(str(i).encode()) % 5 == 0 else v) for i, v in labels]
    a = sorted(map(tuple, q.quality_scores(docs(rows), labels_of(spark, labels)).collect()))
    b = sorted(map(tuple, q.quality_scores(docs(rows).repartition(5), labels_of(spark, flipped)).collect()))
    assert a == b


def test_null_labels_one_class_and_empty_tables(spark, docs):
    table = docs([(1, "a b"), (1, "a b"), (None, "c")])
    labels = labels_of(spark, [(1, None), (None, 1)])
    assert [r["predicted"] for r in q.quality_scores(table, labels).collect()] == [1, 1, 1]
    assert q.quality_scores(table.limit(0), labels).count() == 0
    kept = q.keep_good(docs([(1, "a"), (2, None)], extra=True), labels.limit(0))
    assert kept.count() == 2


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(60)]
    y = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    values = [rng.normal(size=6) for _ in rows]
    c = np.full(60, 0.3)
    w, bias = q.hinge_dual_descent(rows, values, y, c, epochs=2000, tolerance=1e-7)

    def primal(w, bias):
        return 0.5 * (w @ w + bias * bias) + sum(ci * max(0, 1 - yi * (w[r] @ v + bias)) for r, v, yi, ci in zip(rows, values, y, c))
    best = primal(w, bias)
    for _ in range(200):
        d = np.zeros(len(w))
        d[:30] = rng.normal(size=30)
        for step in (1e-3, 1e-2):
            assert primal(w + step * d, bias + step * rng.normal()) >= best - 1e-6


def test_indicators_leave_the_scratch_clean():
    seen = np.zeros(q.N_FEATURES, np.uint8)
    a = q.indicators(b"the the cat", seen)
    assert not seen.any() and (np.diff(a) > 0).all() and len(q.indicators(b"", seen)) == 0


def test_repeated_ids_do_not_pass_the_bound(spark, docs):
    rows, marks = make(40)
    labels = labels_of(spark, marks)
    once = q.train(docs(rows), labels)
    again = q.train(docs(rows + rows + [(i, t + "~ later") for i, t in rows]), labels)
    assert once.bias == again.bias and (once.weights == again.weights).all()
