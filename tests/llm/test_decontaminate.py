import random
import re

from applens.llm import decontaminate as dc
from llm_fixtures import docs  # noqa: F401  (a fixture)


def words_of(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items):
    """Best run over every diagonal of every pair."""
    out = {}
    for d, t in docs:
        w = words_of(t)
        for i, u in items:
            v = words_of(u)
            if len(v) < min(map(len, dc.MASKS)):
                continue
            for first in range(-len(v) + 1, len(w)):
                score = hits = best = best_hits = 0
                for k in range(len(v)):
                    if 0 <= first + k < len(w):
                        score, hits = (score + 1, hits + 1) if w[first + k] == v[k] else (score - dc.MISS_COST, hits)
                        if score <= 0:
                            score = hits = 0
                        if score > best:
                            best, best_hits = score, hits
                if best_hits >= min(dc.MIN_TOKENS, -(-len(v) * 4 // 5)):
                    out[d, i] = max(out.get((d, i), 0), best_hits)
    return out


def make(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(8, 40))) for i in range(25)] + [(90, None), (91, ""), (92, "one two"), (93, "the " * 30)]
    docs = [(0, None), (1, ""), (2, "short one"), (3, "the " * 300), (4, "THE, the! " * 7)]
    for d in range(10, 110):
        base = text(rng.randint(5, 200)).split()
        if d % 2:
            item = rng.choice(items[:25])[1].split()
            for _ in range(rng.randint(0, max(1, len(item) // 9))):
                item[rng.randrange(len(item))] = "swap"
            if d % 10 == 1:
                item = item[len(item) // 2:]
            at = rng.randint(0, len(base))
            base[at:at] = [x.upper() + "," if d % 3 else x for x in item]
        docs.append((d, " ".join(base)))
    return docs, items


def test_against_brute_force_on_both_joins(spark, docs):
    rows, items = make(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    for bound in (dc.BROADCAST_TOKENS, 0):
        got = {(r[0], r[1]): r[2] for r in dc.benchmark_overlaps(docs(rows, extra=True), bench, broadcast_tokens=bound).collect()}
        assert set(got) <= set(want)
        # a seed must survive: all but the most heavily changed passages are found
        assert len(got) >= 0.97 * len(want)
        assert all(got[k] <= want[k] for k in got)


def test_whole_items_are_always_found(spark, docs):
    rows, items = make(2)
    copies = [(1000 + i, f"before {t} after") for i, t in items if t and len(words_of(t)) >= 8]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r[0], r[1]) for r in dc.benchmark_overlaps(docs(copies), bench).collect()}
    assert {(d, d - 1000) for d, _ in copies} <= got


def test_filter_keeps_clean_rows_null_ids_and_columns(spark, docs):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    table = docs([(1, "x " + item), (2, "clean text"), (None, "clean"), (3, None), (2, "clean text")], extra=True)
    out = dc.decontaminated(table, bench)
    assert out.columns == table.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 2, 2, 3]
    assert dc.decontaminated(table, bench.limit(0)).count() == 5
    assert dc.benchmark_overlaps(table.limit(0), bench).count() == 0


def test_main_path_runs_no_python(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    plan = dc.benchmark_overlaps(docs([(1, "a")]), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_passages_with_replaced_tokens_are_mostly_found(spark, docs):
    rng = random.Random(11)
    items = [(i, " ".join(f"t{rng.randint(0, 3000)}" for _ in range(rng.randint(15, 59)))) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for rate, least in ((0.1, 0.95), (0.2, 0.8)):
        rows = [(i, "lead in " + " ".join("other" if rng.random() < rate else w for w in t.split()) + " lead out") for i, t in items]
        rows += [(10_000 + i, " ".join(f"t{rng.randint(0, 3000)}" for _ in range(200))) for i in range(300)]
        got = {r["doc_id"] for r in dc.benchmark_overlaps(docs(rows), bench).collect()}
        assert len([d for d in got if d < 10_000]) >= least * 300 and not [d for d in got if d >= 10_000]


def test_a_document_of_many_passages_keeps_no_copy_of_itself_for_each_hit(spark, docs):
    """20,000 words of items one after another: 54,000 hits, which with all the words each are some 15 GB in one task."""
    rng = random.Random(5)
    items = [(i, " ".join(f"t{rng.randint(0, 3000)}" for _ in range(40))) for i in range(50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    text = " ".join(t for _ in range(10) for _, t in rng.sample(items, 50))
    got = {(r[0], r[1]): r[2] for r in dc.benchmark_overlaps(docs([(1, text), (2, "clean text")]), bench).collect()}
    assert got == {(1, i): 40 for i, _ in items}


def test_texts_under_one_item_id_are_judged_each_by_itself_on_both_joins(spark, docs):
    rng = random.Random(6)
    text = lambda n: " ".join(f"t{rng.randint(0, 3000)}" for _ in range(n))
    items = [(1, text(40)), (1, text(12)), (1, None), (2, text(30))]
    items += [(3, items[0][1]), (3, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(10, "a " + items[0][1] + " b"), (11, items[1][1]), (12, items[1][1] + " " + items[3][1]), (13, "a " * 50),
            (14, " ".join(items[0][1].split()[5:25])), (14, items[3][1])]
    for bound in (dc.BROADCAST_TOKENS, 0):
        got = {(r[0], r[1]): r[2] for r in dc.benchmark_overlaps(docs(rows), bench, broadcast_tokens=bound).collect()}
        assert got == brute(rows, items)
