"""Mixing sources to target weights by a min-cost flow.

Documents may belong to several sources.  They are summed up by membership
pattern (the set of a document's sources); the flow routes each pattern's words
to the quotas of its sources, and a pass over the same words costs more than
the one before it, so repetition is spread as thinly as the quotas allow.  The
graph has a node per pattern and per source, never one per document.  A
pattern's words are then turned into documents: whole passes first, and the
rest of the quota by a seeded order of its documents.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import WORD_PATTERN, pinned

MAX_PATTERNS = 500_000    # one driver row each; more is an error, not a cut
MAX_OVERLAPPING = 20_000  # of these, patterns of several sources or of a source that several patterns share: the flow's search is over them
BUCKET_BITS, STEP_BITS = 32, 8      # the seeded order is searched by so many of its leading bits, a step at a time


def word_count(text: Column | str) -> Column:
    """Number of runs without white space; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_order(sources) -> list:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def weighted_targets(sizes: dict, weights: dict, share: float, max_passes: int) -> dict:
    """Shares ``share`` times all sizes by weight; what passes ``max_passes`` times a source's size goes to the others."""
    targets = {}
    free = {s for s, n in sizes.items() if n > 0 and weights.get(s, 0) > 0}
    left = share * sum(sizes.values())
    while free:
        total = sum(weights[s] for s in free)
        full = [s for s in free if left * weights[s] / total > max_passes * sizes[s]]
        if not full:
            targets |= {s: left * weights[s] / total for s in free}
            break
        for s in full:
            targets[s] = float(max_passes * sizes[s])
            left -= targets[s]
            free.discard(s)
    return {s: targets.get(s, 0.0) for s in sizes}


def route(pattern_sizes: list[tuple[tuple, int]], quotas: dict, max_passes: int) -> list[int]:
    """Words taken from each pattern: the largest flow to the quotas, and of those the cheapest.

    A pattern of one source that no other pattern has is a path of its own, which takes the quota or all passes;
    the rest is searched.
    """
    patterns_of: dict = {}
    for i, (members, _) in enumerate(pattern_sizes):
        for s in members:
            patterns_of.setdefault(s, []).append(i)
    alone = {i for i, (members, _) in enumerate(pattern_sizes) if len(members) == 1 and len(patterns_of[members[0]]) == 1}
    shared = [i for i in range(len(pattern_sizes)) if i not in alone]
    if len(shared) > MAX_OVERLAPPING:
        raise ValueError(f"more than {MAX_OVERLAPPING} patterns of sources overlap")
    taken = [min(round(quotas.get(members[0], 0)), max_passes * size) if i in alone else 0
             for i, (members, size) in enumerate(pattern_sizes)]
    used = {s for i in shared for s in pattern_sizes[i][0]}
    found = _route_shared([pattern_sizes[i] for i in shared], {s: q for s, q in quotas.items() if s in used}, max_passes)
    for i, n in zip(shared, found):
        taken[i] = n
    return taken


def _route_shared(pattern_sizes: list[tuple[tuple, int]], quotas: dict, max_passes: int) -> list[int]:
    """The flow over patterns that share sources.

    Pass k of a pattern's words costs k a word.  Paths of least cost are found
    by label correction (costs on the way back are negative) and filled to their
    narrowest arc, one after the other.
    """
    sources = source_order(quotas)
    first, sink = len(pattern_sizes) + 1, len(pattern_sizes) + 1 + len(sources)
    arcs: list[list[int]] = []                      # to, room, cost; the arc back is at index ^ 1
    out: list[list[int]] = [[] for _ in range(sink + 1)]

    def arc(a: int, b: int, room: int, cost: int) -> None:
        out[a].append(len(arcs))
        arcs.append([b, room, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    at = {s: first + i for i, s in enumerate(sources)}
    passes: list[list[int]] = []
    for i, (members, size) in enumerate(pattern_sizes, 1):
        passes.append([])
        for k in range(max_passes):
            passes[-1].append(len(arcs))
            arc(0, i, size, k)
        for s in members:
            if s in at:
                arc(i, at[s], max_passes * size, 0)
    for s in sources:
        arc(at[s], sink, round(quotas[s]), 0)
    while True:
        cost, came, queue, waiting = {0: 0}, {}, deque([0]), {0}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for e in out[a]:
                b, room, c = arcs[e]
                if room and cost[a] + c < cost.get(b, 1 << 60):
                    cost[b], came[b] = cost[a] + c, e
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        if sink not in came:
            return [sum(arcs[e ^ 1][1] for e in es) for es in passes]
        path, b = [], sink
        while b:
            path.append(came[b])
            b = arcs[came[b] ^ 1][0]
        room = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= room
            arcs[e ^ 1][1] += room


PLAN = "members array<string>, whole bigint, rest bigint, cut bigint, limit_h bigint, limit_key bigint, pick_h bigint, pick_key bigint"


def mix_plan(rows: DataFrame, weights, share: float = 1.5, max_passes: int = 2) -> tuple[DataFrame, dict, dict]:
    """How the mix takes each pattern's rows: a row per pattern, for :func:`passes`; the sources' sizes; their targets.

    ``rows`` holds what :func:`ordered` adds and is read several times, so it should be pinned.  ``weights`` maps the
    ordered list of sources to their weights.  A document of several sources counts for the size of each.

    A pattern's quota is met by whole passes over its rows, then by the rows that come first in
    the seeded order while they fit, then by the one row whose size is nearest to what is left, if it brings the sum
    nearer.  Equal rows share one place in the order and are taken together.
    """
    sums = rows.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of sources")
    patterns = sorted(((tuple(r["members"]), r["size"]) for r in sums), key=lambda p: [(s is None, s or "") for s in p[0]])
    sizes: dict = {}
    for members, size in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + size
    sizes = {s: sizes[s] for s in source_order(sizes)}
    targets = weighted_targets(sizes, weights(list(sizes)), share, max_passes)
    taken = route(patterns, targets, max_passes)

    spark = rows.sparkSession
    quota = spark.createDataFrame([(list(p), t // s if s else 0, t % s if s else 0) for (p, s), t in zip(patterns, taken)],
                                  "members array<string>, whole bigint, rest bigint")
    sized = rows.join(F.broadcast(quota), "members").filter((F.col("size") > 0) & (F.col("rest") > 0))
    cuts = _cuts(sized.select("members", "bucket", "size"), quota.filter("rest > 0").select("members", F.col("rest").alias("room")))
    sized = sized.join(F.broadcast(cuts), "members")
    # within that bucket, the last place that still fits
    places = (sized.filter(F.col("bucket") == F.col("cut")).groupBy("members", "h", "row_key")
              .agg(F.sum("size").alias("size"), F.first("room").alias("room")))
    upto = Window.partitionBy("members").orderBy("h", "row_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    limits = (places.withColumn("run", F.sum("size").over(upto)).withColumn("fits", F.col("run") <= F.col("room"))
              .groupBy("members").agg(F.max(F.when(F.col("fits"), F.struct("run", "h", "row_key"))).alias("last"), F.first("room").alias("room"))
              .select("members", F.col("last.h").alias("limit_h"), F.col("last.row_key").alias("limit_key"),
                      (F.col("room") - F.coalesce(F.col("last.run"), F.lit(0))).alias("gap")))
    plan = quota.join(cuts.drop("room"), "members", "left").join(limits, "members", "left")
    off = F.abs(F.col("size") - F.col("gap"))
    picks = (sized.drop("cut", "rest", "whole", "room").join(F.broadcast(plan), "members").filter(~_first_in_order() & (F.col("gap") > 0))
             .groupBy("members", "h", "row_key").agg(F.sum("size").alias("size"), F.first("gap").alias("gap")).filter(off < F.col("gap"))
             .groupBy("members").agg(F.min(F.struct(off.alias("off"), "h", "row_key")).alias("p"))
             .select("members", F.col("p.h").alias("pick_h"), F.col("p.row_key").alias("pick_key")))
    found = plan.join(picks, "members", "left").select([c.split()[0] for c in PLAN.split(", ")]).collect()
    return spark.createDataFrame(found, PLAN), sizes, targets


def _cuts(sized: DataFrame, quotas: DataFrame) -> DataFrame:
    """(members, room, cut): the bucket in which each pattern's quota runs out, and what is left of the quota there.

    Found from the leading bits down: each step sums the words of 256 parts of the part found before, so
    no window ever holds more than these, however many rows a pattern has.
    """
    state = quotas.withColumn("cut", F.lit(0).cast("bigint"))
    for done in range(0, BUCKET_BITS, STEP_BITS):
        rest_bits = BUCKET_BITS - done
        part = F.shiftright("bucket", rest_bits - STEP_BITS)
        sums = (sized.join(F.broadcast(state), "members").filter(F.shiftright("bucket", rest_bits) == F.col("cut"))
                .groupBy("members", part.alias("part")).agg(F.sum("size").alias("words"), F.first("room").alias("room")))
        before = Window.partitionBy("members").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        found = (sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
                 .filter((F.col("before") <= F.col("room")) & (F.col("before") + F.col("words") > F.col("room")))
                 .select("members", (F.col("room") - F.col("before")).alias("room"), F.col("part").alias("cut")).collect())
        state = sized.sparkSession.createDataFrame(found, "members array<string>, room bigint, cut bigint")
    return state


def _first_in_order() -> Column:
    """Whether a row comes before the place at which its pattern's quota runs out."""
    here = (F.col("h") < F.col("limit_h")) | ((F.col("h") == F.col("limit_h")) & (F.col("row_key") <= F.col("limit_key")))
    return F.coalesce((F.col("bucket") < F.col("cut")) | ((F.col("bucket") == F.col("cut")) & here), F.lit(False))


def passes() -> Column:
    """Times the mix takes a row that :func:`ordered` has prepared and the plan has joined; rows without words count as whole passes do."""
    picked = F.coalesce((F.col("h") == F.col("pick_h")) & (F.col("row_key") == F.col("pick_key")), F.lit(False))
    extra = (F.col("rest") > 0) & (F.col("size") > 0) & (_first_in_order() | picked)
    return F.col("whole") + extra.cast("bigint")


def ordered(rows: DataFrame, members: Column, size: Column, order_key: Column, row_key: Column, seed: int = 42) -> DataFrame:
    """``rows`` with members (distinct, in order), size, and their place in the seeded order (bucket, h, row_key)."""
    h = F.xxhash64(F.lit(seed), order_key)
    return rows.withColumns({"members": F.array_sort(F.array_distinct(members)), "size": size, "h": h, "row_key": row_key,
                             "bucket": F.shiftrightunsigned(h, 64 - BUCKET_BITS)})


def repeating_weights(pattern=(3, 1, 2)):
    return lambda sources: {s: pattern[i % len(pattern)] for i, s in enumerate(sources)}


def _prepared(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, members, size, h, row_key, bucket) of documents of one source each; rows agree in row_key if in id, source and text."""
    doc_id, source, text = F.col(id_col).cast("bigint"), F.col(source_col).cast("string"), F.col(text_col).cast("string")
    return ordered(docs.select(doc_id.alias("doc_id"), source.alias("source"), text.alias("text")), F.array("source"),
                   word_count("text"), F.col("doc_id"), F.xxhash64("doc_id", "source", "text"), seed).drop("source", "text")


def mix_report(docs: DataFrame, weights=None, share: float = 1.5, max_passes: int = 2, seed: int = 42, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken.

    Null sources are one source, last in order; null and empty texts have size
    0 and nothing is taken from them; rows equal in id, source and text are taken equally often; further columns
    are not read; an empty table gives no rows.
    """
    rows = pinned(_prepared(docs, seed, id_col, text_col, source_col))
    plan, sizes, targets = mix_plan(rows, weights or repeating_weights(), share, max_passes)
    by_source = docs.sparkSession.createDataFrame([([s], sizes[s], targets[s]) for s in sizes],
                                                  "members array<string>, source_size bigint, target double")
    return (rows.join(F.broadcast(plan), "members").join(F.broadcast(by_source), "members")
            .select("doc_id", "size", "source_size", "target", (F.col("size") * passes()).alias("taken")))


def mixed_documents(docs: DataFrame, weights=None, share: float = 1.5, max_passes: int = 2, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it; rows without words once.

    The plan is broadcast (a row per pattern of sources), so documents are not shuffled.
    """
    plan, _, _ = mix_plan(pinned(_prepared(docs, seed, id_col, text_col, source_col)), weights or repeating_weights(), share, max_passes)
    row = F.struct(*(docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)))
    doc_id, source, text = docs[id_col].cast("bigint"), docs[source_col].cast("string"), docs[text_col].cast("string")
    placed = ordered(docs.select(row.alias("row"), doc_id.alias("doc_id"), source.alias("source"), text.alias("text")), F.array("source"),
                     word_count("text"), F.col("doc_id"), F.xxhash64("doc_id", "source", "text"), seed)
    times = F.when(F.col("size") > 0, passes()).otherwise(1).cast("int")
    return (placed.join(F.broadcast(plan), "members").select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("copy"))
            .select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns))))
