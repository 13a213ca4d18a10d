"""Conversation structure repair: cheapest edits by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows read, last role written): nothing, a leading
system row, user or assistant.  Edits are its edges.  A forward and a reverse
heap grow towards each other; once the two least costs together exceed the best
meeting, every cheapest path crosses from a settled forward node to a settled
reverse one, and the least concatenated audit over those crossings is the
answer.  Two audits of equal cost that lead to one node are never prefixes of
one another (an edit that reads no row costs something), so least parts make
least wholes.

Conversations are dealt to tasks whole.  One of more than ``ROWS`` rows or
``CHARS`` characters is cut into segments over many tasks: each is searched for
every pair of last roles before and after it, the segments' answers are put
together in order, and its text is hashed as it streams past.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import SPACE, pinned, tidy

ROWS = 1024
CHARS = 4 << 20
_CACHED = 64             # longest conversation whose search is remembered

# costs of the contract
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# states: what was written last
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (NOTHING, ASSISTANT)
_WRITES = (USER, USER, ASSISTANT, USER)               # the only user/assistant row that may follow each state
_KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_LEGAL = ("su", "ua", "au")
_INITIALS = "sua"
_MUST, _CUT = 4, 8                                    # flags of a row's code, beside its initial


def row_code(role: str, must: bool, cut: bool) -> int:
    """A row as the lattice sees it: initial of its role, whether it must go, whether it is cut short."""
    at = _INITIALS.find(role[:1]) if role else -1
    return (at if at >= 0 else 3) | _MUST * must | _CUT * cut


def _keeps(state: int, code: int) -> int | None:
    return _KEEPS[state].get(_INITIALS[code & 3]) if code & 3 < 3 else None


def search(codes: bytes, start: int = NOTHING, goals: tuple[int, ...] = GOALS) -> tuple[int, str] | None:
    """(cost, least audit) of the cheapest edits of the rows ``codes`` that lead from ``start`` to one of ``goals``; None if none do."""
    n = len(codes)

    def ahead(i: int, q: int):
        if i < n:
            code = codes[i]
            yield i + 1, q, DELETE, "D"
            if not code & _MUST:
                extra = TRUNCATED if code & _CUT else 0
                kept = _keeps(q, code)
                if kept is not None:
                    yield i + 1, kept, KEEP + extra, "K"
                yield i + 1, _WRITES[q], REROLE + extra, "R"
        yield i, _WRITES[q], INSERT, "I"

    def behind(i: int, q: int):
        if i:
            code = codes[i - 1]
            yield i - 1, q, DELETE, "D"
            if not code & _MUST:
                extra = TRUNCATED if code & _CUT else 0
                for p in range(4):
                    if _keeps(p, code) == q:
                        yield i - 1, p, KEEP + extra, "K"
                    if _WRITES[p] == q:
                        yield i - 1, p, REROLE + extra, "R"
        for p in range(4):
            if _WRITES[p] == q:
                yield i, p, INSERT, "I"

    # per side: tentative (cost, audit) of nodes, settled nodes, heap.  Edges that cost nothing read a row, so
    # among nodes of one cost those with fewer rows behind them are settled first and audits are final when popped
    fore, back = {(0, start): (0, "")}, {(n, q): (0, "") for q in goals}
    done_fore, done_back = set(), set()
    heap_fore, heap_back = [(0, 0, start)], [(0, -n, q) for q in goals]
    heapq.heapify(heap_back)
    best = min((0 for at in fore if at in back), default=float("inf"))
    while True:
        for heap, done, sign in ((heap_fore, done_fore, 1), (heap_back, done_back, -1)):
            while heap and (sign * heap[0][1], heap[0][2]) in done:
                heapq.heappop(heap)
        top_fore = heap_fore[0][0] if heap_fore else float("inf")
        top_back = heap_back[0][0] if heap_back else float("inf")
        if top_fore + top_back > best or not (heap_fore or heap_back):
            break
        forward = top_fore <= top_back
        if forward:
            cost, i, q = heapq.heappop(heap_fore)
            mine, other, done, edges = fore, back, done_fore, ahead
        else:
            cost, i, q = heapq.heappop(heap_back)
            i = -i
            mine, other, done, edges = back, fore, done_back, behind
        done.add((i, q))
        audit = mine[i, q][1]
        for j, p, price, letter in edges(i, q):
            reached = (cost + price, audit + letter if forward else letter + audit)
            known = mine.get((j, p))
            if known is None or reached < known:
                mine[j, p] = reached
                if known is None or reached[0] < known[0]:
                    heapq.heappush(heap_fore if forward else heap_back, (reached[0], j if forward else -j, p))
            if (j, p) in other:
                best = min(best, reached[0] + other[j, p][0])
    if best == float("inf"):
        return None
    done_fore.add((0, start))           # both ends are known even if their heap never moved
    done_back.update((n, q) for q in goals)
    crossings = []
    for at in done_fore:
        cost, audit = fore[at]
        if at in done_back and cost + back[at][0] == best:
            crossings.append(audit + back[at][1])
        for j, p, price, letter in ahead(*at):
            if (j, p) in done_back and cost + price + back[j, p][0] == best:
                crossings.append(audit + letter + back[j, p][1])
    return int(best), min(crossings)


_remembered = lru_cache(1 << 15)(search)


def cheapest(codes: bytes) -> tuple[int, str]:
    return (_remembered if len(codes) <= _CACHED else search)(codes)


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) rows that ``audit`` makes of ``rows``."""
    state = NOTHING
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = _keeps(state, row_code(role, False, False))
        else:
            state = _WRITES[state]
            role = ("user", "assistant")[state == ASSISTANT]
        yield role, text


class _Hash:
    """SHA-256 of newline-joined ``role:text`` rows."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any = True


def damaged(rows: DataFrame) -> DataFrame:
    """The damage the contract asks for, by CRC-32 of ``conv_id:turn``: (conv_id, turn, role, text, tie).

    ``tie`` orders rows of one turn and is the same for equal rows."""
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    hit = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), code.alias("code")).filter("code <> 0")
    out = hit.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                     F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                     F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_"))
    return out.select("conv_id", "turn", "role", "text", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("tie"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "tie")


class _Part:
    """Rows of a conversation in order, counted; of a whole one or of a segment."""

    def __init__(self) -> None:
        self.codes, self.faults = bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last, self.first = 0, None, None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        said = text.rstrip(SPACE)
        fault = "blank" if not said else "duplicate" if seen else "truncated" if said[-1] not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        self.codes.append(row_code(role, fault in ("blank", "duplicate"), fault == "truncated"))
        if self.first is None:
            self.first = role[:1]
        else:
            self.illegal += self.last + role[:1] not in _LEGAL
        self.last = role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


_RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_HASHED = f"{_RESULT}, repaired_sha256 string"
_SEGMENT = ("conv_id bigint, task int, place bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, "
            "last string, low bigint, high bigint, turns bigint, costs array<bigint>, audits array<string>")
_TYPES = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64()),
          "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns))


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input in order, conversations of bounded size: one is held at a time."""
    out, conv, part, texts, seen = [], None, None, [], set()

    def close() -> None:
        cost, audit = cheapest(bytes(part.codes))
        digest = _Hash()
        for role, text in repaired_rows(audit, iter(texts)):
            digest.add(role, text)
        out.append((conv, part.gaps(), *part.faults.values(), part.illegal, cost, audit, digest.sha.hexdigest()))

    for c, turn, role, text, tie in _rows(batches, "conv_id", "turn", "role", "text", "tie"):
        if part is not None and c != conv:
            close()
            part = None
            if len(out) >= 2000:
                yield _batch(out, _HASHED)
                out.clear()
        if part is None:
            conv, part, texts, seen = c, _Part(), [], set()
        part.add(turn, role, text, tie in seen)
        seen.add(tie)
        texts.append((role, text))
    if part is not None:
        close()
    if out:
        yield _batch(out, _HASHED)


def _segments(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input in order and flagged: each segment's counts, and its answer for every state before and after."""
        task, place = TaskContext.get().partitionId(), 0
        conv, part, before = None, None, None

        def closed() -> pa.RecordBatch:
            found = [search(bytes(part.codes), a, (b,)) for a in range(4) for b in range(4)]
            return _batch([(conv, task, place, *part.faults.values(), part.illegal, part.first, part.last, part.low, part.high, part.turns,
                            [f and f[0] for f in found], [f and f[1] for f in found])], _SEGMENT)

        for c, turn, role, text, tie, later in _rows(batches, "conv_id", "turn", "role", "text", "tie", "later"):
            if part is not None and (c != conv or len(part.codes) >= most):
                yield closed()
                part, place = None, place + 1
            if part is None:
                conv, part = c, _Part()
            part.add(turn, role, text, later or before == (c, turn, tie))
            before = (c, turn, tie)
        if part is not None:
            yield closed()
    return run


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order: the counts and the cheapest edits of each conversation."""
    names = [f.split(" ")[0] for f in _SEGMENT.split(", ")]
    conv, ways, whole = None, None, None

    def closed() -> pa.RecordBatch:
        cost, audit = min(ways[q] for q in GOALS if ways[q])
        return _batch([(conv, whole.gaps(), *whole.faults.values(), whole.illegal, cost, audit)], _RESULT)

    for row in _rows(batches, *names):
        s = dict(zip(names, row))
        if whole is not None and s["conv_id"] != conv:
            yield closed()
            whole = None
        if whole is None:
            conv, whole, ways = s["conv_id"], _Part(), [(0, ""), None, None, None]
        for fault in whole.faults:
            whole.faults[fault] += s[fault]
        whole.illegal += s["illegal"] + (whole.last is not None and whole.last + s["first"] not in _LEGAL)
        whole.last = s["last"]
        if s["low"] is not None:
            whole.turns += s["turns"] - (whole.high == s["low"])
            whole.low, whole.high = s["low"] if whole.low is None else whole.low, s["high"]
        ways = [min(((ways[a][0] + s["costs"][4 * a + b], ways[a][1] + s["audits"][4 * a + b])
                     for a in range(4) if ways[a] and s["costs"][4 * a + b] is not None), default=None) for b in range(4)]
    if whole is not None:
        yield closed()


def _hash_streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation its audit, then its rows in order: the hash of the repaired rows, no text held."""
    rows = _rows(batches, "conv_id", "body", "role", "text")
    for conv, own in groupby(rows, key=lambda r: r[0]):
        audit = next(own)[3]
        digest = _Hash()
        for role, text in repaired_rows(audit, ((role, text) for _, _, role, text in own)):
            digest.add(role, text)
        yield _batch([(conv, digest.sha.hexdigest())], "conv_id bigint, repaired_sha256 string")


def _repair_long(rows: DataFrame, most: int) -> DataFrame:
    """Conversations of any size, in segments over many tasks."""
    rows = pinned(rows)
    again = rows.groupBy("conv_id", "tie").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = again.select(F.col("conv_id").alias("_c"), F.col("tie").alias("_t"), F.col("first.turn").alias("_first"))
    later = F.col("_t").isNotNull() & F.col("turn").isNotNull() & (F.col("_first").isNull() | (F.col("turn") > F.col("_first")))
    flagged = rows.join(again, rows["conv_id"].eqNullSafe(again["_c"]) & (rows["tie"] == again["_t"]), "left").select(
        rows["*"], F.coalesce(later, F.lit(False)).alias("later"))
    segments = _in_order(flagged.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "tie")).mapInArrow(tidy(_segments(most)), _SEGMENT)
    segments = pinned(segments)
    found = pinned(segments.repartition("conv_id").sortWithinPartitions("conv_id", "task", "place").mapInArrow(tidy(_put_together), _RESULT))
    empty = F.lit(None)
    streamed = (rows.withColumn("body", F.lit(1)).unionByName(found.select(
        "conv_id", empty.cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("tie"), F.lit(0).alias("body"))))
    hashes = (_in_order(streamed.repartition("conv_id"), "body").mapInArrow(tidy(_hash_streamed), "conv_id bigint, repaired_sha256 string")
              .withColumnRenamed("conv_id", "_c"))
    return found.join(hashes, found["conv_id"].eqNullSafe(hashes["_c"])).drop("_c")


def repaired(conversations: DataFrame, rows_most: int = ROWS, chars_most: int = CHARS) -> DataFrame:
    """Damages each conversation, counts its faults and finds its cheapest repair; a row per conv_id.

    Rows are taken by turn, null first; rows of one turn by a digest of role
    and text, so equal rows are neighbours and their order never matters.
    Null ids are one conversation.  Null roles and texts become one space.
    Conversations of which the damage leaves no row have zeros, an empty audit
    and the hash of nothing.  An empty table gives no rows; further columns
    are not read.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    ids = pinned(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars")))
    long = ids.filter(f"n > {int(rows_most)} OR chars > {int(chars_most)}").select(F.col("conv_id").alias("_c"))
    hit = damaged(rows)

    def whole(some: DataFrame) -> DataFrame:
        return _in_order(some.repartition("conv_id")).mapInArrow(tidy(_repair_whole), _HASHED)

    if long.isEmpty():
        found = whole(hit)
    else:
        is_long = hit["conv_id"].eqNullSafe(long["_c"])
        found = whole(hit.join(long, is_long, "left_anti")).unionByName(_repair_long(hit.join(long, is_long, "left_semi"), rows_most))
    found = found.withColumnRenamed("conv_id", "_c")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.select("conv_id").join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
            .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
