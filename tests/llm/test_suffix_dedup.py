import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from applens.llm import suffix_dedup as sd
from llm_fixtures import docs  # noqa: F401  (a fixture)


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def make(seed, n=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "é", "stone", "river", "a", "walked", "zu", "ñandú"]
    text = lambda k: " ".join(rng.choice(vocab) + str(rng.randint(0, 300)) for _ in range(k))
    passage, hot = text(40), text(70)
    rows = [(0, None), (1, ""), (2, "x" * 199), (3, "y" * 201), (4, "z" * 200), (5, "z" * 200), (6, "ab" * 700), (7, text(400) * 2)]
    for d in range(10, n):
        parts = [text(rng.randint(1, 60))]
        if rng.random() < 0.4:
            parts.append(passage[rng.randint(0, 40):len(passage) - rng.randint(0, 40)])
        if rng.random() < 0.3:
            parts.append(hot[:rng.randint(150, len(hot))])
        if rng.random() < 0.3:
            near = list(rows[-1][1] or "")
            if near:
                near[rng.randrange(len(near))] = "#"
            parts.append("".join(near))
        parts.append(text(rng.randint(0, 30)))
        rows.append((d, " ".join(parts)))
    rows += [(1000, rows[12][1]), (1001, rows[12][1])]
    return rows


@pytest.mark.parametrize("hot", [sd.HOT_CONTEXTS, 2])
def test_against_brute_force(docs, hot):
    rows = make(1)
    got = sorted((tuple(r)[:5] for r in sd.repeated_spans(docs(rows, extra=True), hot_contexts=hot).collect()), key=str)
    assert got == brute(rows, 200)


def test_other_lengths_long_texts_and_small_pieces(docs, monkeypatch):
    rows = make(2, 30) + [(500, make(3, 20)[-3][1] * 30)]
    got = sorted((tuple(r)[:5] for r in sd.repeated_spans(docs(rows), length=64, gram=20).collect()), key=str)
    assert got == brute(rows, 64)


def test_pieces_of_a_long_text_hold_every_window_once():
    text = bytes(random.Random(4).choices(b"ab", k=5000))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([text.decode()])], names=["key", "did", "text"])
    old, sd.CHUNK = sd.CHUNK, 700
    try:
        pieces = list(sd._pieces(batch, 50))
        starts = [at + i for _, _, at, b in pieces for i in range(len(b) - 49)]
        assert starts == list(range(5000 - 49)) and all(text[at:at + len(b)] == b for _, _, at, b in pieces)
    finally:
        sd.CHUNK = old


def test_suffix_order_equals_plain_sorting():
    for seed in range(6):
        rng = random.Random(seed)
        unit = bytes(rng.choices(b"ab", k=rng.randint(1, 50)))
        x = unit * 12 + bytes(rng.choices(b"abc", k=300)) + unit * 9
        n, reach = len(x), 200
        starts = np.array(sorted(rng.sample(range(n - reach), min(250, n - reach))))
        order = sd.sorted_suffixes(np.frombuffer(x, np.uint8), starts, reach)
        assert sorted(order.tolist()) == starts.tolist()
        keys = [x[i:i + reach] for i in order.tolist()]
        assert keys == sorted(keys)


def test_cover_has_a_step_for_every_pair():
    x = np.zeros(100, np.uint8)
    c = sd.CoverRanks(x, sd._words(x), 60)
    for a in range(sd.V):
        for b in range(sd.V):
            assert {(a + c.step[a, b]) % sd.V, (b + c.step[a, b]) % sd.V} <= set(sd.COVER)


def test_repeated_rows_null_ids_and_empty_table(docs):
    long = " ".join(f"w{i}" for i in range(100))
    got = sorted((tuple(r)[:4] for r in sd.repeated_spans(docs([(1, long), (1, long), (None, long + "x"), (2, "short")])).collect()), key=str)
    n = len(long)
    assert got == sorted([(1, n, n, 1), (1, n, n, 1), (None, n + 1, n, 1), (2, 5, 0, 0)], key=str)
    assert sd.repeated_spans(docs([(1, "a")]).limit(0)).count() == 0


def test_many_copies_of_one_row_cost_what_as_many_ids_cost(docs):
    """Spans are kept once per text and id, so copies do not multiply them."""
    import time
    text = " ".join(f"word{i}" for i in range(500))[:3000]

    def took(rows):
        table, began = docs(rows).repartition(4).cache(), time.time()
        table.count()
        got = [tuple(r)[:4] for r in sd.without_repeats(table).collect()]
        assert len(got) == len(rows) and {g[1:] for g in got} == {(3000, 3000, 1)}
        return time.time() - began
    took([(i, text) for i in range(20)])
    apart = took([(i, text) for i in range(400)])
    assert took([(7, text)] * 400) < 4 * apart + 5
