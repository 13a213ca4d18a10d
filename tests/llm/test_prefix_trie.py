import hashlib
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from applens.llm import prefix_trie as pt
from applens.llm.oracles import PREFIX_TRIE

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    """The contract, with nodes as tuples of turns."""
    own = {}
    for conv in {r[0] for r in rows} - {None}:
        mine = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, hashlib.md5(f"{len(m[1])}:{m[1]}{m[2]}".encode()).hexdigest()))
        own[conv] = [m[1:] for m in mine]
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = int(c / 100) * 100               # towards zero, as SQL's remainder
        full[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), kids.get(node, 0), leaves[node], saved[node],
                    hashlib.sha256(",".join(str(c) for c in sorted(who) if full[c] == node).encode()).hexdigest())
                   for node, who in members.items()), key=str)


def conversations(seed, groups, longest, odd=True):
    rng, rows = random.Random(seed), []
    says = ["Hi.", "Yes", "Grüße 😀", "", None, "x" * 50]
    for g in groups:
        for c in [g * 100, *(g * 100 + rng.randrange(1, 100) for _ in range(25))]:
            if c == 300 or any(r[0] == c for r in rows):
                continue
            for t in range(rng.randint(1, longest)):
                turn = rng.choice([t, t, None, 1]) if odd else t
                rows.append((c, turn, rng.choice(["user", "assistant", None, ""]) if odd else "user", rng.choice(says)))
    rows += [(None, 0, "user", "no conversation"), (5, 3, "user", "Hi."), (5, 3, "user", "Hi.")]
    rng.shuffle(rows)
    return rows


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_and_sql_against_brute_force(spark, tmp_dir):
    rows = conversations(4, [0, 1, 3, -2], 12)
    rows += [(c, t, "user", f"same {t}") for c in range(700, 760) for t in range(8)]
    table = spark.createDataFrame(rows, SCHEMA)
    want = by_hand(rows)
    assert collected(pt.prefix_nodes(table.selectExpr("*", "1 AS a", "'x' AS depth", "2 AS place"))) == want
    table.coalesce(1).write.parquet(tmp_dir + "/c")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_dir}/c/*.parquet')")
    assert sorted(con.execute(PREFIX_TRIE).fetchall(), key=str) == want
    assert collected(pt.prefix_nodes(table.limit(0))) == []


def test_conversations_longer_than_a_range(spark):
    """One conversation holds most rows, so several sorted ranges share it."""
    rows = conversations(6, [0], 4, odd=False) + [(c, t, "user", f"{t % 7}") for c in (12, 13) for t in range(700)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    width = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert collected(pt.prefix_nodes(table)) == by_hand(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", width)


def test_only_a_root(spark):
    turnless = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(turnless, 0, "user", "Hi.")]
    assert collected(pt.prefix_nodes(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)
    assert len(by_hand(rows)) == 1


def test_totals_of_any_tree(spark):
    rng = random.Random(9)
    for shape in ("path", "random", "caterpillar", "star"):
        up = {0: None}
        for i in range(1, 150):
            up[i] = {"path": i - 1, "random": rng.randrange(i), "caterpillar": i - 1 if i % 3 else max(0, i - 3), "star": 0}[shape]
        weight = {i: rng.randrange(100) for i in up}
        want = dict(weight)
        for i in sorted(up, reverse=True):
            if up[i] is not None:
                want[up[i]] += want[i]
        table = spark.createDataFrame([(i, -i, u, None if u is None else -u, weight[i]) for i, u in up.items()],
                                      "a long, b long, up_a long, up_b long, w long")
        got = pt.subtree_totals(table, ["w"]).select("a", F.col("w")).collect()
        assert sorted(map(tuple, got)) == sorted(want.items())
