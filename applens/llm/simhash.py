"""SimHash near-duplicates, found with pivot distance tables.

Fingerprints that differ in at most ``max_bits`` bits agree on two of
``max_bits + 2`` blocks of bits, so rows are dealt by every pair of blocks and
compared within a deal only.  There each fingerprint gets a row of a distance
table: its Hamming distances to reference fingerprints.  By the triangle
inequality two fingerprints whose rows differ by more than ``max_bits`` in any
column cannot be linked, which discards nearly all pairs before any is verified
bit by bit.  Leaders of the deal serve as further references: points within
reach of a leader are linked to it, so a dense group of near copies costs its
size times its leaders and gives one link a point, never all its pairs.  A deal
that spreads too wide for a few leaders is cut by its bits and compared group by group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, id_and_text, pinned, tidy
from applens.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 16
HOT_DEAL = 1 << 15       # fingerprints; larger deals are dealt again by more bits, until none is left
LEADERS = 64             # of a group that is compared through them; a group with more is cut by its bits
GROUP = 512              # fingerprints of one such cut that are compared by their rows of the table
_CHUNK = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    first, last = starts[:n].tolist(), ends[shingle - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        h = np.fromiter((digest(view[a:b], SEED) for a, b in zip(first[at:at + _CHUNK], last[at:at + _CHUNK])), "<u8",
                        min(_CHUNK, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _sign(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per row, the fingerprint's bits as a signed long."""
    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(_sign(shingle)), "doc_id bigint, fp bigint")


def _blocks(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """Bits low..high-1 in n blocks: (first bit, width)."""
    edges = [low + (high - low) * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bits(blocks) -> int:
    """The mask that holds just the bits of ``blocks``."""
    return sum((1 << width) - 1 << first for first, width in blocks)


def _deals(max_bits: int) -> list[int]:
    """Masks on at least one of which any two fingerprints within ``max_bits`` are equal."""
    return [_bits(pair) for pair in combinations(_blocks(0, 64, max_bits + 2), 2)]


def _finer(mask: int, max_bits: int) -> list[int]:
    """``mask`` with a part of its open bits each; two fingerprints within ``max_bits`` that agree on it agree on one of these."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | _bits((b, 1) for b in rest[first:first + width]) for first, width in _blocks(0, len(rest), max_bits + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


_REFERENCES = np.random.default_rng(7).integers(0, 1 << 64, size=PIVOTS, dtype=np.uint64)


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances to fixed reference fingerprints, one row each."""
    return np.bitwise_count(fp[:, None] ^ _REFERENCES[None, :]).astype(np.int8)


def link_deal(fp: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Positions (i, j) of links that connect exactly what all links within ``max_bits`` connect.

    A group of at most LEADERS leaders is compared through them.  A group that spreads wider is cut by the bits in which its
    fingerprints vary: in ``max_bits + 1`` parts of these, two linked fingerprints agree on at least one part.  Groups that a part
    still leaves large are taken up in turn, so the cost of a fingerprint does not grow with those that are far from it.
    """
    n = len(fp)
    links: list[tuple[int, int]] = []
    if n == 2:
        if np.abs(table[0] - table[1]).max() <= max_bits and (int(fp[0]) ^ int(fp[1])).bit_count() <= max_bits:
            links.append((0, 1))
        return links

    def near(i: int, among: np.ndarray) -> np.ndarray:
        could = among[np.abs(table[among] - table[i]).max(axis=1) <= max_bits]
        return could[np.bitwise_count(fp[could] ^ fp[i]) <= max_bits]

    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((i, j))

    def by_leaders(group: np.ndarray) -> bool:
        """Links a group through its leaders; False if there are more than LEADERS, with some links found."""
        # every point is within reach of its own leader, leaders are out of each other's
        open_, leaders, own = group, [], []
        while len(open_):
            if len(leaders) == LEADERS:
                return False
            i = int(open_[0])
            mine = near(i, open_)
            for j in mine[mine != i].tolist():
                join(i, j)
            leaders.append(i)
            own.append(mine)
            open_ = open_[~np.isin(open_, mine, assume_unique=True)]
        # links across: only leaders within three reaches can have linked points
        lead = np.array(leaders)
        for a in range(len(lead) - 1):
            apart = np.bitwise_count(fp[lead[a + 1:]] ^ fp[lead[a]])
            for b in (a + 1 + np.nonzero(apart <= 3 * max_bits)[0]).tolist():
                if find(leaders[a]) == find(leaders[b]):
                    continue
                few, many = sorted((own[a], own[b]), key=len)
                for x in few.tolist():
                    hit = near(x, many)
                    if len(hit):
                        join(x, int(hit[0]))
                        break
        return True

    def by_table(group: np.ndarray, key: np.ndarray) -> None:
        """Links points of equal key; ``group`` is sorted by it and no key has more than GROUP points."""
        placed, since = np.empty(n, np.int64), len(group) + 1
        for step in range(1, GROUP):
            at = np.nonzero(key[step:] == key[:-step])[0]
            if not len(at):
                return
            if since > len(group):            # points that are known to be connected need no further look
                placed[group], since = [find(x) for x in group.tolist()], 0
            i, j = group[at], group[at + step]
            apart = placed[i] != placed[j]
            i, j = i[apart], j[apart]
            for column in columns:
                close = np.abs(column[i] - column[j]) <= max_bits
                i, j = i[close], j[close]
            linked = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
            since += int(linked.sum())
            for x, y in zip(i[linked].tolist(), j[linked].tolist()):
                join(x, y)

    columns = np.ascontiguousarray(table.T)
    work = [np.arange(n)]
    while work:
        group = work.pop()
        if by_leaders(group) or len({find(x) for x in group.tolist()}) == 1:
            continue
        varying = int(np.bitwise_or.reduce(fp[group] ^ fp[group[0]]))
        bits = [b for b in range(64) if varying >> b & 1]
        for first, width in _blocks(0, len(bits), max_bits + 1):
            key = fp[group] & np.uint64(_bits((b, 1) for b in bits[first:first + width]))
            order = np.argsort(key, kind="stable")
            key, dealt = key[order], group[order]
            size = np.diff(np.nonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))[0])
            small = np.repeat(size <= GROUP, size)
            by_table(dealt[small], key[small])
            ends = np.cumsum(size)
            work.extend(dealt[ends[k] - size[k]:ends[k]] for k in np.nonzero(size > GROUP)[0].tolist())
    return links


def _link_partition(max_bits: int, hot: int):
    names = ["mask", "key", "a", "b"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    def may_spill(mask: int) -> bool:
        """Whether a deal has bits to be dealt by; with as few as ``max_bits`` open it holds 2 ** max_bits fingerprints at most."""
        return 64 - (mask % (1 << 64)).bit_count() > max_bits

    def again(mask: int, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of a hot deal, dealt once more by each finer mask."""
        n = len(fp)
        for finer in _finer(mask % (1 << 64), max_bits):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, _signed(finer))), pa.array((fp & np.uint64(finer)).view(np.int64)),
                 pa.array(fp.view(np.int64)), pa.nulls(n, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input sorted by (mask, key): one deal is held at a time, a hot one not even whole."""
        at, held, spilling, out = None, [], False, []

        def close() -> Iterator[pa.RecordBatch]:
            if at is None or not held:
                return
            if spilling:
                yield from again(at[0], np.concatenate([f for f, _ in held]))
            elif len(held) > 1 or len(held[0][0]) > 1:
                fp, table = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*held))
                signed = fp.view(np.int64)
                out.extend((*at, int(signed[i]), int(signed[j])) for i, j in link_deal(fp, table, max_bits))

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp")]
            fp = cols[2].view(np.uint64)
            table = pivot_table(fp)
            turns = np.nonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))[0] + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(fp)]):
                key = (int(cols[0][a]), int(cols[1][a]))
                if key != at:
                    yield from close()
                    at, held, spilling = key, [], False
                held.append((fp[a:b], table[a:b]))
                if b - a + sum(len(f) for f, _ in held[:-1]) > hot and may_spill(key[0]):
                    spilling = True
                    yield from again(at[0], np.concatenate([f for f, _ in held]))
                    held = []
            if len(out) > 10_000:
                yield batch_of(out)
                out.clear()
        yield from close()
        if out:
            yield batch_of(out)
    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_DEAL) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) whose components are those of all pairs within ``max_bits``."""
    deals = F.array(*(F.struct(F.lit(_signed(m)).cast("bigint").alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("key"))
                      for m in _deals(max_bits)))
    rows = distinct.select("fp", F.explode(deals).alias("d")).select("d.mask", "d.key", "fp")
    links = None
    while True:
        met = pinned(rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
                     .mapInArrow(tidy(_link_partition(max_bits, hot)), "mask bigint, key bigint, a bigint, b bigint"))
        found, more = met.filter("b IS NOT NULL").select("a", "b"), met.filter("b IS NULL")
        links = links.unionAll(found) if links is not None else found
        if more.isEmpty():
            return links
        # a hot deal is dealt until it is bounded: every turn fixes more bits, and two ways may lead to one mask
        rows = more.select("mask", "key", F.col("a").alias("fp")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    Null and empty texts have fingerprint zero and are linked like any other;
    texts of fewer words than a shingle hash as a whole.  Repeated rows are
    kept; null ids never name a component that has another id.  Other columns
    are not read; an empty table gives no rows.
    """
    signed = pinned(fingerprints(docs, shingle, id_col, text_col))
    nodes = pinned(signed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(nodes.select("fp"), max_bits))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    # kept apart, so that a component of very many fingerprints is a plain skewed join, which Spark splits
    names = pinned(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    by_print = placed.join(names, "root").select("fp", "component_id")
    return (signed.join(by_print, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def near_deduplicated(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of its smallest id, with all columns.

    Rows of one id and one text count as one; a null id stays if no other id is reachable.
    """
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    kept = pinned(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("_keep"))
                  .agg((F.count(F.lit(1)) > 1).alias("_again")))

    def rows_of(ids: DataFrame) -> DataFrame:
        return docs.join(ids, docs[id_col].eqNullSafe(ids["_keep"]), "left_semi")

    return rows_of(kept.filter("not _again")).unionAll(rows_of(kept.filter("_again")).dropDuplicates([id_col, text_col]))
