import random

import numpy as np
import pyarrow as pa
import xxhash

from applens.llm import simhash as sh
from applens.llm.components import components
from llm_fixtures import docs  # noqa: F401  (a fixture)


def by_hand(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_documents_against_brute_force(spark, docs):
    rng = random.Random(4)
    vocab = [f"Wörd{i}" for i in range(50)] + ["THE", "a"]
    rows = [(7, None), (3, ""), (9, " \t"), (5, "one two"), (6, "one two three four"), (8, "ONE\x0btwo"), (4, "x " * 40_000), (2, "é" * 9000)]
    for d in range(20, 120):
        if d % 3 and d > 25:
            words = rows[-1][1].split()
            words[rng.randrange(len(words))] = "changed"
        else:
            words = [rng.choice(vocab) for _ in range(rng.randint(3, 120))]
        rows.append((d, rng.choice([" ", "\n", "  "]).join(words)))
    prints = [by_hand(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (d, _), r in zip(rows, roots):
        least[r] = min(least.get(r, d), d)
    want = sorted((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, roots))
    assert sorted(map(tuple, sh.near_duplicates(docs(rows, extra=True)).collect())) == want


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(6)
    prints = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            prints.add(x)
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    want = brute_components(prints)
    for hot in (sh.HOT_DEAL, 5):
        pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in sh.fingerprint_links(table, hot=hot).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
        at = {p: i for i, p in enumerate(prints)}
        root = list(range(len(prints)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            x, y = find(at[a]), find(at[b])
            root[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(prints))] == want


def test_one_dense_deal():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, size=6, dtype=np.uint64)
    fp = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64))
                                   ^ (np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64))
                                   ^ (np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64)) for b in base]))
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = sh.link_deal(fp, sh.pivot_table(fp), 4)
    for i, j in links:
        assert int(fp[i] ^ fp[j]).bit_count() <= 4
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fp))] == brute_components([int(x) for x in fp])
    assert len(links) < len(fp)


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(300, 340)] + [(7, 8), (8, 9), (9, 7), (4, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in [*range(300, 340), 500]} == {300}
    assert [got[7], got[8], got[9]] == [7, 7, 7] and 4 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_rows_null_ids_empty_table_and_filter(spark, docs):
    table = docs([(2, "same text here now"), (2, "same text here now"), (5, "same text here now"), (None, "alone in the null row"), (9, "other words are here")], extra=True)
    kept = sh.near_deduplicated(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 9]
    assert sh.near_duplicates(table.limit(0)).count() == 0


def test_no_deal_of_any_level_is_compared_while_it_is_hot(monkeypatch):
    """Very many near fingerprints: deals are dealt again until they are small, and links still connect all."""
    center, hot = 0x0123456789ABCDEF, 200
    prints = {center}
    for a in range(64):
        for b in range(a):
            prints.add(center ^ 1 << a ^ 1 << b)
    fp = np.array(sorted(prints), np.uint64)
    sizes, real = [], sh.link_deal
    monkeypatch.setattr(sh, "link_deal", lambda f, t, m: sizes.append(len(f)) or real(f, t, m))
    rows = {(sh._signed(m), sh._signed(int(x) & m), sh._signed(int(x))) for m in sh._deals(4) for x in fp}
    links, levels = [], 0
    while rows:
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(rows))], names=["mask", "key", "fp"])
        out = [r for b in sh._link_partition(4, hot)(iter([batch])) for r in b.to_pylist()]
        links += [(r["a"], r["b"]) for r in out if r["b"] is not None]
        rows = {(r["mask"], r["key"], r["a"]) for r in out if r["b"] is None}
        levels += 1
    assert levels > 2 and max(sizes) <= hot
    root = {sh._signed(int(x)): sh._signed(int(x)) for x in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        assert (a % (1 << 64) ^ b % (1 << 64)).bit_count() <= 4
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert len({find(x) for x in root}) == 1


def test_wide_deals_are_cut_and_keep_all_links(monkeypatch):
    """Deals of more leaders than are compared at once, loose and dense, against all pairs; with groups that are cut again too."""
    rng = np.random.default_rng(9)
    open_bits = ~np.uint64((1 << 21) - 1)

    def flipped(fp, times):
        for _ in range(times):
            fp = fp ^ (np.uint64(1) << rng.integers(21, 64, len(fp), dtype=np.uint64))
        return fp
    centers = rng.integers(0, 1 << 64, size=40, dtype=np.uint64)
    deals = [rng.integers(0, 1 << 64, size=900, dtype=np.uint64), flipped(centers[rng.integers(0, 40, 900)], 4),
             flipped(centers[rng.integers(0, 3, 900)], 7), flipped(np.repeat(centers[:1], 900), 10)]
    for group in (sh.GROUP, 20):
        monkeypatch.setattr(sh, "GROUP", group)
        for deal in deals:
            fp = np.unique(deal & open_bits)
            links = sh.link_deal(fp, sh.pivot_table(fp), 4)
            root = list(range(len(fp)))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for i, j in links:
                assert int(fp[i] ^ fp[j]).bit_count() <= 4 and find(i) != find(j)
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
            assert [find(i) for i in range(len(fp))] == brute_components([int(x) for x in fp])
