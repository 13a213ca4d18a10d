"""Trie of conversation prefixes, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns.  It is named by the exclusive or
of 128-bit hashes of its (place, turn) pairs, so the name of a node and of its
parent are known on every row once the hashes before it are summed up; that
is done in tasks over sorted ranges, and a conversation that is cut by the end
of a range is put right by one offset per range, so no conversation has to fit
in a task.

Subtree totals come from tree contraction.  A rake adds every leaf to its
parent and removes it; a compress takes out all unary chains at once, by
pointer doubling along them, and keeps what each taken node lacks: the total of
its chain's end.  Rakes and compresses alternate until the root is left, after
a number of rounds that is logarithmic in the number of nodes whatever the
tree's depth; then the chains are opened again in reverse order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import pinned, tidy

GROUP = 100              # conversations that share the turns of their first one
HEADS = 6                # first turns taken from there: a hash of the id modulo this
MAX_ROUNDS = 200         # each rake and compress at least halves the leaves; not reaching the root is an error

_BELOW_ROOT = "a <> 0 OR b <> 0"


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by conversation and turn: the task and, within it, each turn's place in its conversation."""
    task, conv, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.nonzero(ids[1:] != ids[:-1])[0] + 1]) if len(ids) else np.zeros(0, int)
        place = np.arange(1, len(ids) + 1)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            at = at if ids[a] == conv else 0
            place[a:b] += at - a
            conv, at = ids[a], int(place[b - 1])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(ids), task, np.int32)), pa.array(place),
                                          batch.column("tie"), batch.column("points")], names=["conv_id", "task", "place", "tie", "points"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by conversation and place: per turn the hash of (place, turn) and of all such pairs of its conversation in this task."""
    task, conv, so_far = TaskContext.get().partitionId(), None, np.zeros((1, 2), np.uint64)
    for batch in batches:
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        places, ties = batch.column("place").to_pylist(), batch.column("tie").to_pylist()
        own = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b"%d:%s" % (p, t.encode())) for p, t in zip(places, ties)), np.uint64).reshape(-1, 2)
        all_ = np.empty_like(own)
        starts = np.concatenate([[0], np.nonzero(ids[1:] != ids[:-1])[0] + 1]) if len(ids) else np.zeros(0, int)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            before = so_far if ids[a] == conv else np.zeros((1, 2), np.uint64)
            all_[a:b] = np.bitwise_xor.accumulate(np.concatenate([before, own[a:b]]))[1:]
            conv, so_far = ids[a], all_[b - 1:b]
        columns = [pa.array(np.ascontiguousarray(x[:, i]).view(np.int64)) for x in (own, all_) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(np.full(len(ids), task, np.int32)), batch.column("place"), batch.column("points"),
             batch.column("last"), *columns], names=["conv_id", "task", "place", "points", "last", "own_a", "own_b", "a", "b"])


def _earlier(rows: DataFrame, **totals) -> DataFrame:
    """(_c, _t, totals over earlier tasks) of conversations that several ranges share: at most two rows a range."""
    parts = rows.groupBy("conv_id", "task").agg(*(t.alias(n) for n, t in totals.items()))
    w = Window.partitionBy("conv_id")
    before = w.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    how = {n: F.sum(n) if n == "place" else F.bit_xor(n) for n in totals}
    split = (parts.withColumn("_n", F.count(F.lit(1)).over(w)).select(
        F.col("conv_id").alias("_c"), F.col("task").alias("_t"), "_n", *(F.coalesce(f.over(before), F.lit(0)).alias(f"_{n}") for n, f in how.items()))
        .filter("_n > 1").drop("_n"))
    return F.broadcast(pinned(split))


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, tie, points): turns in order; ``tie`` stands for role and text."""
    empty = F.lit("")
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                                F.coalesce(F.col("text").cast("string"), empty).alias("text")).filter("conv_id IS NOT NULL")
    rows = rows.select("conv_id", "turn", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("tie"),
                       F.length("text").cast("bigint").alias("points"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "tie"]
    placed = pinned(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        tidy(_placed), "conv_id bigint, task int, place bigint, tie string, points bigint"))
    earlier = _earlier(placed, place=F.max("place"))
    return (placed.join(earlier, (F.col("conv_id") == F.col("_c")) & (F.col("task") == F.col("_t")), "left")
            .select("conv_id", (F.col("place") + F.coalesce("_place", F.lit(0))).alias("place"), "tie", "points"))


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) once each conversation begins with turns of the first of its group.

    Turns have conv_id, place, tie, points and whether they are the last; conversations conv_id and length.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % group).alias("first"))
    firsts = sizes.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    convs = pinned(convs.join(firsts, "first", "left").withColumn("lent", F.least("h", F.coalesce("n_first", F.lit(0))))
                   .withColumn("length", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    heads_of = turns.filter((F.col("conv_id") % group == 0) & (F.col("place") < heads)).withColumnRenamed("conv_id", "first")
    lent = heads_of.join(convs.select("conv_id", "first", "lent", "length"), "first").filter("place <= lent")
    own = (turns.join(convs.select("conv_id", "h", "lent", "length"), "conv_id").filter("place > h")
           .withColumn("place", F.col("place") - F.col("h") + F.col("lent")))
    both = [x.select("conv_id", "place", "tie", "points", (F.col("place") == F.col("length")).alias("last")) for x in (lent, own)]
    return both[0].unionAll(both[1]), convs.select("conv_id", "length")


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by (a, b, conv_id): the hash of each node's comma-joined ids, as they stream past."""
    rows = (r for batch in batches for at in range(0, batch.num_rows, 4096)
            for r in zip(*(batch.column(c).slice(at, 4096).to_pylist() for c in ("a", "b", "conv_id"))))
    out = []
    for (a, b), own in groupby(rows, key=lambda r: r[:2]):
        sha = hashlib.sha256(str(next(own)[2]).encode())
        for _, _, conv in own:
            sha.update(b",%d" % conv)
        out.append((a, b, sha.hexdigest()))
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b", "ends_sha256"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b", "ends_sha256"])


def _sum(*names: str):
    out = F.lit(0).cast("bigint")
    for n in names:
        out = out + F.coalesce(n, F.lit(0))
    return out


def subtree_totals(nodes: DataFrame, measures: list[str]) -> DataFrame:
    """(a, b, measures): sums over each node's subtree, itself included.

    ``nodes`` names a node (a, b) and its parent (up_a, up_b); the root is (0, 0), and its parent null.
    """
    late = [f"late_{m}" for m in measures]       # what goes to the parent with a node's total, for nodes taken out between them
    active = pinned(nodes.select("a", "b", "up_a", "up_b", *measures, *(F.lit(0).cast("bigint").alias(x) for x in late)))
    totals, chains = None, []
    for _ in range(MAX_ROUNDS):
        # rake: leaves go to their parents
        parents = active.filter("up_a IS NOT NULL").select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).distinct()
        leaf = active.filter(_BELOW_ROOT).join(parents, ["a", "b"], "left_anti")
        leaves = pinned(leaf)
        mine = leaves.select("a", "b", *measures)
        totals = mine if totals is None else totals.unionAll(mine)
        given = leaves.groupBy("up_a", "up_b").agg(*(F.sum(F.col(m) + F.col(x)).alias(f"got_{m}") for m, x in zip(measures, late)))
        given = given.select(F.col("up_a").alias("a"), F.col("up_b").alias("b"), *(f"got_{m}" for m in measures))
        active = pinned(active.join(leaves.select("a", "b"), ["a", "b"], "left_anti").join(given, ["a", "b"], "left").select(
            "a", "b", "up_a", "up_b", *(_sum(m, f"got_{m}").alias(m) for m in measures), *late))
        if active.filter(_BELOW_ROOT).isEmpty():
            break
        # compress: nodes with one child point past it until they point at their chain's end
        only = (active.filter("up_a IS NOT NULL").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("to_a"), F.min("b").alias("to_b"), *(F.min(x).alias(f"of_{x}") for x in late))
                .filter("n = 1"))
        chain = pinned(active.filter(_BELOW_ROOT).join(only, ["a", "b"]).select(
            "a", "b", "up_a", "up_b", "to_a", "to_b", *late, *(_sum(m, f"of_late_{m}").alias(m) for m in measures), F.lit(True).alias("moved")))
        while not chain.filter("moved").isEmpty():
            past = chain.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col("to_a").alias("past_a"), F.col("to_b").alias("past_b"),
                                *(F.col(m).alias(f"past_{m}") for m in measures))
            chain = pinned(chain.join(past, ["to_a", "to_b"], "left").select(
                "a", "b", "up_a", "up_b", F.coalesce("past_a", "to_a").alias("to_a"), F.coalesce("past_b", "to_b").alias("to_b"), *late,
                *(_sum(m, f"past_{m}").alias(m) for m in measures), F.col("past_a").isNotNull().alias("moved")))
        chains.append(chain.select("a", "b", "to_a", "to_b", *measures))
        taken = chain.select("a", "b")
        top = chain.join(taken.select(F.col("a").alias("up_a"), F.col("b").alias("up_b")), ["up_a", "up_b"], "left_anti").select(
            F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.col("up_a").alias("top_a"), F.col("up_b").alias("top_b"),
            *((F.col(m) + F.col(x)).alias(f"top_{x}") for m, x in zip(measures, late)))
        active = pinned(active.join(taken, ["a", "b"], "left_anti").join(top, ["a", "b"], "left").select(
            "a", "b", F.coalesce("top_a", "up_a").alias("up_a"), F.coalesce("top_b", "up_b").alias("up_b"), *measures,
            *(F.coalesce(f"top_{x}", x).alias(x) for x in late)))
    else:
        raise RuntimeError(f"tree not contracted after {MAX_ROUNDS} rounds")
    totals = totals.unionAll(active.select("a", "b", *measures))
    for chain in reversed(chains):
        end = totals.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), *(F.col(m).alias(f"end_{m}") for m in measures))
        opened = chain.join(end, ["to_a", "to_b"]).select("a", "b", *((F.col(m) + F.col(f"end_{m}")).alias(m) for m in measures))
        totals = totals.unionAll(pinned(opened))
    return totals


def prefix_nodes(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """A row per distinct prefix of the rebuilt conversations, with its members, children, subtree totals and ends.

    Turns are taken in order, null first; turns of one number by a digest of
    role and text, so that equal rows are neighbours.  Null roles and texts
    count as empty.  Rows without a conv_id belong to no conversation and are
    left out.  An empty table has no conversation and no root.  Further columns
    are not read.
    """
    rows, convs = rebuilt(_turns(conversations), group, heads)
    named = pinned(rows.repartitionByRange("conv_id", "place").sortWithinPartitions("conv_id", "place").mapInArrow(
        tidy(_named), "conv_id bigint, task int, place bigint, points bigint, last boolean, own_a bigint, own_b bigint, a bigint, b bigint"))
    earlier = _earlier(named, a=F.bit_xor("own_a"), b=F.bit_xor("own_b"))
    members = (named.join(earlier, (F.col("conv_id") == F.col("_c")) & (F.col("task") == F.col("_t")), "left")
               .withColumn("a", F.col("a").bitwiseXOR(F.coalesce("_a", F.lit(0)))).withColumn("b", F.col("b").bitwiseXOR(F.coalesce("_b", F.lit(0))))
               .select("conv_id", "place", "points", "last", "a", "b", F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"),
                       F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b")))
    members = pinned(members)
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    below = members.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.max("place").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                          F.max("points").alias("points"), F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("a"), zero.alias("b"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("points"), none.alias("up_a"), none.alias("up_b"))
    nodes = below.unionByName(root)
    kids = below.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = pinned(nodes.join(kids, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", zero))
                   .withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
                   .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("points")))
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"])
    ends = members.filter("last").select("a", "b", "conv_id").unionAll(convs.filter("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    hashes = (ends.repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")
              .mapInArrow(tidy(_hash_ids), "a bigint, b bigint, ends_sha256 string"))
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.drop("n_leaves", "saved_tokens").join(totals, ["a", "b"]).join(hashes, ["a", "b"], "left").join(parents, ["up_a", "up_b"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
