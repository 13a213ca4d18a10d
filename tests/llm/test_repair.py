import hashlib
import itertools
import random
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from applens.llm import repair as rp
from applens.llm.oracles import CONVERSATION_REPAIR

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def accepts(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(body) > 0 and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def every_way(codes, inserts):
    """(cost, audit) of all edit sequences with at most ``inserts`` inserts at a time, by enumeration."""
    ways = []
    for n in itertools.product(range(inserts + 1), repeat=len(codes) + 1):
        for kinds in itertools.product("KRD", repeat=len(codes)):
            roles, cost, audit = [], 0, ""
            for i, count in enumerate(n):
                roles += ["ua"] * count
                cost, audit = cost + 5 * count, audit + "I" * count
                if i == len(codes):
                    break
                initial, must, cut = "sua?"[codes[i] & 3], codes[i] & 4, codes[i] & 8
                if kinds[i] != "D" and must:
                    break
                audit += kinds[i]
                cost += {"K": 0, "R": 1, "D": 2}[kinds[i]] + (5 if cut and kinds[i] != "D" else 0)
                if kinds[i] != "D":
                    roles.append(initial if kinds[i] == "K" else "ua")
            else:
                raise AssertionError
            if len(audit) < len(codes) + sum(n):
                continue
            if any(accepts("".join(p)) for p in itertools.product(*roles)):
                ways.append((cost, audit))
    return min(ways)


def by_rows(codes):
    """The same by dynamic programming, a row at a time."""
    best = {0: (0, "")}
    write = {0: 2, 1: 2, 2: 3, 3: 2}

    def offer(ways, q, way):
        if q not in ways or way < ways[q]:
            ways[q] = way

    def inserted(ways):
        for _ in range(4):
            for q, (cost, audit) in list(ways.items()):
                offer(ways, write[q], (cost + 5, audit + "I"))
        return ways
    inserted(best)
    for code in codes:
        after = {}
        for q, (cost, audit) in best.items():
            offer(after, q, (cost + 2, audit + "D"))
            if not code & 4:
                cost += 5 * bool(code & 8)
                offer(after, write[q], (cost + 1, audit + "R"))
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, "sua?"[code & 3]))
                if to:
                    offer(after, to, (cost, audit + "K"))
        best = inserted(after)
    return min(best[q] for q in (0, 3) if q in best)


CODES = st.sampled_from([a | b for a in range(4) for b in (0, 4, 8)])


@settings(max_examples=60, deadline=None)
@given(st.lists(CODES, max_size=4))
def test_search_against_every_edit_sequence(codes):
    assert rp.search(bytes(codes)) == every_way(codes, 1)


@settings(max_examples=400, deadline=None)
@given(st.lists(CODES, max_size=40))
def test_search_against_dynamic_programming(codes):
    assert rp.search(bytes(codes)) == by_rows(codes)


def by_hand(rows):
    """The contract, row by row."""
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if code:
                text = "" if code == 1 else "".join(x for x in text if x not in ".!?") if code == 2 else text
                mine += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, codes = [], []
        for i, (_, role, text) in enumerate(mine):
            said = text.strip(SPACE)
            faults.append("blank" if not said else "duplicate" if (role, text) in [m[1:] for m in mine[:i]]
                          else "truncated" if said[-1] not in ".!?" else "")
            at = "sua".find(role[:1]) if role else 3
            codes.append((at if at >= 0 else 3) | 4 * (faults[-1] in ("blank", "duplicate")) | 8 * (faults[-1] == "truncated"))
        turns = {r[0] for r in mine} - {None}
        cost, audit = by_rows(codes)
        lines, left, state = [], list(mine), "start"
        for letter in audit:
            _, role, text = (None, "", "") if letter == "I" else left.pop(0)
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append(f"{role}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def conversations(seed, many, longest):
    rng, rows = random.Random(seed), []
    says = ["Hi.", "Hi.", "What is it?", "no end", "", " \t", None, "Ünü!\n", "two\nlines.", "stop. "]
    for c in [*range(many), None, -7]:
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.9:
                t = rng.choice([turn, turn, turn, turn + 3, None, 2])
                rows.append((c, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sage"]), rng.choice(says)))
    rng.shuffle(rows)
    return rows


def collected(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_rows_and_sql_against_brute_force(spark, tmp_dir):
    rows = conversations(2, 120, 9) + conversations(5, 3, 60)
    table = spark.createDataFrame(rows, SCHEMA)
    want = by_hand(rows)
    out = rp.repaired(table.selectExpr("*", "1 AS n", "'x' AS audit", "'y' AS tie"))
    assert collected(out) == want
    table.coalesce(1).write.parquet(tmp_dir + "/c")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_dir}/c/*.parquet')")
    assert sorted(con.execute(CONVERSATION_REPAIR).fetchall(), key=lambda r: (r[0] is None, r[0] or 0)) == want
    assert collected(rp.repaired(table.limit(0))) == []


def test_long_conversations_in_segments(spark):
    """The same rows whatever the segments are."""
    rows = conversations(3, 25, 40)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = by_hand(rows)
    assert collected(rp.repaired(table, rows_most=4)) == want
    assert collected(rp.repaired(table, rows_most=13)) == want
    assert collected(rp.repaired(table, chars_most=30)) == want


def test_conversation_that_loses_all_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = rp.repaired(spark.createDataFrame([(gone, 0, "user", "Hello.")], SCHEMA))
    assert collected(out) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
