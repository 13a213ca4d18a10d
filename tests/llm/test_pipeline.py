"""The pipeline's stages, each against a brute-force version over the rows its predecessor kept."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from applens.llm import mixing, quality, simhash
from applens.llm.queries import tokenizer_path
from test_decontaminate import brute as brute_overlaps
from test_quality import make as quality_rows
from test_simhash import brute_components
from llm_fixtures import docs  # noqa: F401  (a fixture)


@pytest.fixture
def sf_dir(spark, docs, tmp_dir):
    rng = random.Random(8)
    rows, labels = quality_rows(200)
    item = " ".join(f"exam{i}" for i in range(30))
    out = [(i, t, f"s{i % 3}") for i, t in rows]
    out += [(1000 + i, out[1][1] + (" extra" if i > 3 else ""), "s0") for i in range(8)]
    out += [(2000 + i, f"the house {i} stood {rng.random()} under {item} quiet river", None) for i in range(3)]
    out += [(3000, None, "s1"), (3001, "", "s2"), (3002, " ".join(rng.choice(["light", "stone", "of"]) + str(i) for i in range(30_000)), "s1")]
    docs(out).repartition(3).write.parquet(tmp_dir + "/documents.parquet")
    spark.createDataFrame([(i, v, 0) for i, v in labels], "doc_id long, quality int, toxic int").write.parquet(tmp_dir + "/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(tmp_dir + "/benchmark.parquet")
    return tmp_dir


def test_every_stage_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(sf_dir + "/documents.parquet")
    columns, kept = docs.columns, []
    for number, (name, stage) in enumerate(cp.STAGES):
        result = stage(spark, docs, sf_dir)
        path = str(tmp_path / f"stage{number}")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        if number < len(cp.STAGES) - 1:
            assert docs.columns == columns, name
        kept.append([r.asDict() for r in docs.collect()])
    start = [r.asDict() for r in spark.read.parquet(sf_dir + "/documents.parquet").collect()]

    model = quality.train(spark.read.parquet(sf_dir + "/documents.parquet"), spark.read.parquet(sf_dir + "/labels.parquet"))
    seen = np.zeros(quality.N_FEATURES, np.uint8)
    good = [r for r in start if model.score(model.margin(quality.indicators((r["text"] or "").encode(), seen))) >= quality.THRESHOLD]
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    assert ids(kept[0]) == ids(good) and 0 < len(good) < len(start)

    prints = [simhash.fingerprint((r["text"] or "").encode()) for r in kept[0]]
    groups: dict = {}
    for r, g in zip(kept[0], brute_components(prints)):
        groups.setdefault(g, []).append(r["doc_id"])
    assert ids(kept[1]) == sorted(map(min, groups.values())) and len(kept[1]) < len(kept[0])

    bench = [tuple(r) for r in spark.read.parquet(sf_dir + "/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_overlaps([(r["doc_id"], r["text"]) for r in kept[1]], bench)}
    assert ids(kept[2]) == [d for d in ids(kept[1]) if d not in leaks] and leaks

    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in kept[2]}
    by_source = Counter()
    for r in kept[2]:
        by_source[r["source"]] += sizes[r["doc_id"]]
    order = mixing.source_order(by_source)
    targets = mixing.weighted_targets({s: by_source[s] for s in order}, dict(zip(order, [3, 1, 2, 3])), 1.5, 2)
    times, words = Counter(r["doc_id"] for r in kept[3]), Counter()
    for r in kept[3]:
        words[r["source"]] += sizes[r["doc_id"]]
    assert max(times.values()) <= 2 and set(times) <= set(sizes)
    assert all(abs(words[s] - targets[s]) <= 40 or s == "s1" for s in order)

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for r in kept[3]:
        found = tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want[r["doc_id"], len(found), zlib.crc32(np.array(found, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in kept[4]) == want
    in_order = sorted(kept[4], key=lambda r: r["start"])
    assert [r["doc_id"] for r in in_order] == sorted(r["doc_id"] for r in in_order)
    assert [r["start"] for r in in_order] == [0, *np.cumsum([r["n_tokens"] for r in in_order])[:-1].tolist()]


def test_run_gives_the_rows_of_the_stages_and_leaves_only_the_last_folder(spark, sf_dir, tmp_path, monkeypatch):
    docs = spark.read.parquet(sf_dir + "/documents.parquet")
    for number, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / f"by-hand{number}"))
        docs = spark.read.parquet(str(tmp_path / f"by-hand{number}"))
    used = []
    monkeypatch.setattr(cp, "scratch", lambda spark, name: used.append(str(tmp_path / name)) or used[-1])
    got = cp.run(spark, sf_dir)
    assert got.columns == docs.columns and got.count() == docs.count() > 100
    assert got.exceptAll(docs).isEmpty() and docs.exceptAll(got).isEmpty()
    assert [os.path.exists(p) for p in used] == [False] * 4 + [True]


def test_run_over_an_empty_table(spark, docs, tmp_dir):
    docs([(1, "a")]).limit(0).write.parquet(tmp_dir + "/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(tmp_dir + "/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(tmp_dir + "/benchmark.parquet")
    assert cp.run(spark, tmp_dir).count() == 0
