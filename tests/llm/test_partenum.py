import random
import re

import numpy as np

from applens.llm import partenum as pe
from llm_fixtures import docs  # noqa: F401  (a fixture)


def by_hand(text, size=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=90):
    """Rows of the contract, by comparing all pairs."""
    sets = [by_hand(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words))
        words[at:at + 1] = rng.choice([[], ["new%d" % rng.randrange(99)], [words[at], "more"]])
    return words


def corpus(seed, families, copies):
    rng = random.Random(seed)
    vocab = [f"Wörd{i}" for i in range(300)] + ["THE", "a"]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 10, 12, 14, 25, 40, 60, 200, 700]))]
        for _ in range(rng.randint(1, copies)):
            rows.append((len(rows) + 50, rng.choice([" ", "\n", " \t "]).join(edited(rng, base, rng.randint(0, 1 + len(base) // 30)))))
    rng.shuffle(rows)
    return rows


def test_documents_against_all_pairs(spark, docs):
    odd = [(7, None), (3, ""), (9, " \t\x0b"), (5, "one two"), (6, "ONE\x0btwo"), (8, "one two three"), (8, "one two three"), (4, "x " * 40_000),
           (2, "é" * 9000), (1, "One two Three"), (None, "null id " * 5), (None, "lone null id"), (12, "null id " * 5), (11, "İ I i"), (10, "İ i i")]
    rows = odd + corpus(3, 30, 6)
    out = pe.similar_documents(docs(rows, extra=True))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert got(out) == brute(rows)
    assert got(pe.similar_documents(docs([]))) == []


def test_groups_without_a_centre_and_deals_by_blocks(spark, docs, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    chain = [base]
    for _ in range(25):
        chain.append(edited(rng, chain[-1], 1))
    rows = [(i, " ".join(w)) for i, w in enumerate(chain)]
    rows += [(100 + i, " ".join(edited(rng, base, 3))) for i in range(60)]
    want = brute(rows)
    assert len({c for _, _, c in want}) > 5
    monkeypatch.setattr(pe, "DEAL", 7)
    assert got(pe.similar_documents(docs(rows))) == want
    monkeypatch.setattr(pe, "FEW_IDS", 3)
    assert got(pe.similar_documents(docs(rows))) == want


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for percent in (80, 90, 95):
        for n in [*range(1, 60), 100, 333, 1000, 5000]:
            for _ in range(4):
                common = rng.integers(0, 1 << 64, n, np.uint64)
                a = np.unique(common)
                gone = rng.integers(0, 1 + (100 - percent) * n // 100)
                more = rng.integers(0, 1 + (100 - percent) * n // 100)
                b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 1 << 64, more, np.uint64)]))
                both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                if 100 * both >= percent * union and both < union:
                    assert len(np.intersect1d(pe.signatures(a, percent), pe.signatures(b, percent)))
                    assert union - both <= pe.most_apart(len(a) + len(b), percent)
                    found = list(pe.close_pairs([pe.parity_sketch(a, percent), pe.parity_sketch(b, percent)], np.array([len(a), len(b)]),
                                                np.array([0, 1]), np.array([0, 0]), False, percent))
                    assert found == [(0, 1)]


def test_words_do_not_depend_on_pieces(monkeypatch):
    text = b" Some  words\nand a_very_long_word_indeed more of\tthem " * 9
    want = pe.shingle_set(text)
    monkeypatch.setattr(pe, "_PIECE", 5)
    assert np.array_equal(pe.shingle_set(text), want)
