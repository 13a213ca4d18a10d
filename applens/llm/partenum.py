"""N-gram Jaccard join with PartEnum signatures.

Two sets with ``100 * intersection >= percent * union`` have sizes in the same
or in neighbouring bands, and their symmetric difference has at most
``most_apart`` elements, a bound fixed by the bands.  The feature domain is cut
into ``n1`` partitions so small that in one of them the two differ by ``k2``
elements at most; each partition is cut again into ``n2`` parts, and every
choice of ``n2 - k2`` parts of a partition is signed by the elements it holds.
Sets that are similar enough therefore share a signature, whatever they are.

Sets that share a signature are a bucket.  A bucket is first compared with one
of its members, the one that shares most signatures (the text that the others
were copied from, if there is one), so that a dense group costs its size and
not its pairs.  What is then still in different components is compared by
parity sketches, which never lie further apart than the sets do, in deals of
bounded size; pairs that pass and all pairs with a leader are verified on the
whole sets.  Components of the links found are those of all links.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, id_and_text, pinned, tidy
from applens.llm.components import components

SHINGLE = 3
PERCENT = 90
STARS = 2                # turns in which buckets are compared with one member
DEAL = 2048              # members of a bucket that one deal compares; larger buckets are dealt block by block
FEW_IDS = 1 << 20        # as many ids of candidates are broadcast, 8 MB; more are shuffled
_PIECE = 1 << 20
_SEEN = 50_000
_SPACE = re.compile(rb"[ \t-\r]")
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(33))) * _U(0xff51afd7ed558ccd)
    x = (x ^ (x >> _U(29))) * _U(0xc4ceb9fe1a85ec53)
    return x ^ (x >> _U(32))


def _word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words, a piece of the text at a time."""
    found, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + _PIECE) if len(text) - at > _PIECE else None
        end = cut.start() if cut else len(text)
        words = text[at:end].lower().split()
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, _U)


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence if it has fewer words."""
    words = _word_hashes(text)
    if not len(words):
        return words
    size = min(shingle, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, _U)
    for i in range(size):
        h = _mixed(h ^ words[i:i + n])
    return np.unique(h)


@lru_cache(None)
def _bands(percent: int, upto: int) -> tuple[tuple[int, int], ...]:
    """Bands of sizes (least, largest); sets similar enough are in one band or in neighbouring ones."""
    bands, low = [], 1
    while low <= upto:
        bands.append((low, 100 * low // percent))
        low = bands[-1][1] + 1
    return tuple(bands)


def _band(n: int, percent: int) -> tuple[int, tuple[tuple[int, int], ...]]:
    """The band of a size, and all bands up to two beyond it."""
    bands = _bands(percent, 1 << (2 * n + 16).bit_length())
    low, high = 0, len(bands)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if bands[middle][0] <= n else (low, middle)
    return low, bands


def most_apart(sizes: int, percent: int) -> int:
    """Elements in the symmetric difference of two sets of ``sizes`` elements together, at most."""
    return (100 - percent) * sizes // (100 + percent)


def _instances(n: int, percent: int) -> list[tuple[int, int]]:
    """(instance, difference it bears) that a set of ``n`` elements signs.

    Instance b joins band b - 1 with itself and with band b; one that bears
    no difference would join equal sets only and is left out.
    """
    at, bands = _band(n, percent)
    out = []
    for b in (at, at + 1):
        if b == 0:
            continue
        below, above = bands[b - 1][1], bands[b]
        meet = 100 * below >= percent * above[0]
        if b == at and not meet:
            continue
        k = most_apart(below + (above[1] if meet else below), percent)
        if k:
            out.append((b, k))
    return out


@lru_cache(4096)
def _shape(k: int) -> tuple[int, int, tuple[tuple[int, ...], ...]]:
    """(n1, n2, choices of parts): for a difference of k, some partition differs by as few elements as choices leave out parts."""
    n1, n2 = (1, 5) if k <= 2 else ((k + 2) // 2, 3)
    k2 = k // n1
    return n1, n2, tuple(combinations(range(n2), n2 - k2))


def signatures(elements: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The set's PartEnum signatures."""
    where = _mixed(elements ^ _U(0x9e3779b97f4a7c15))
    value = _mixed(elements ^ _U(0xd1b54a32d192ed03))
    out = []
    for b, k in _instances(len(elements), percent):
        n1, n2, choices = _shape(k)
        cell = ((where >> _U(32)) * _U(n1) >> _U(32)) * _U(n2) + ((where & _U(0xffffffff)) * _U(n2) >> _U(32))
        order = np.argsort(cell, kind="stable")
        total = np.concatenate([np.zeros(1, _U), np.cumsum(value[order], dtype=_U)])
        edge = np.searchsorted(cell[order], np.arange(n1 * n2 + 1, dtype=_U))
        parts = (total[edge[1:]] - total[edge[:-1]]).reshape(n1, n2)
        held = np.stack([parts[:, list(c)].sum(axis=1, dtype=_U) for c in choices], axis=1).ravel()
        out.append(_mixed(held ^ _mixed(np.arange(len(held), dtype=_U) + _U(b << 40))))
    return np.concatenate(out) if out else np.zeros(0, _U)


def parity_sketch(elements: np.ndarray, percent: int = PERCENT) -> bytes:
    """Parities of the element counts of 2 ** m cells; two sketches, folded to one length, differ in no more bits than the sets in elements."""
    k = max((k for _, k in _instances(len(elements), percent)), default=1)
    cells = 1 << max(6, (16 * k - 1).bit_length())
    at = (_mixed(elements ^ _U(0x2545f4914f6cdd1d)) & _U(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def _identity(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def _short(key: bytes) -> int:
    """The part of a set's identity that names it beside a signature."""
    return int.from_bytes(key[:8], "little", signed=True)


def _profiles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sid = [], [], []
            for text in byte_texts(batch.column("text")):
                s = shingle_set(text, shingle)
                n.append(len(s))
                key.append(_identity(s))
                sid.append(_short(key[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                                              pa.array(sid, pa.int64())], names=["doc_id", "n", "key", "sid"])
    return run


def _sign(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: OrderedDict[bytes, None] = OrderedDict()      # sets this task has signed lately
        for batch in batches:
            sig, sid, held = [], [], 0
            for text in byte_texts(batch.column("text")):
                s = shingle_set(text, shingle)
                key = _identity(s)
                if not len(s) or key in seen:
                    continue
                seen[key] = None
                if len(seen) > _SEEN:
                    seen.popitem(last=False)
                mine = signatures(s, percent)
                if len(mine):
                    sig.append(mine)
                    sid.append(np.full(len(mine), _short(key)))
                    held += len(mine)
                if held > 1 << 17:
                    yield _two(sig, sid)
                    sig, sid, held = [], [], 0
            if sig:
                yield _two(sig, sid)
    return run


def _two(sig: list[np.ndarray], sid: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(sid))],
                                      names=["sig", "sid"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, sid): those of signatures that two sets have, once each."""
    last, before = None, False
    for batch in batches:
        sig, sid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "sid"))
        if last is not None:
            sig, sid = np.concatenate([last[0], sig]), np.concatenate([last[1], sid])
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])
        sig, sid = sig[fresh], sid[fresh]
        same = sig[1:] == sig[:-1]
        shared = np.concatenate([[before], same])
        shared[:-1] |= same
        ready = np.nonzero(shared[:-1])[0]
        if len(ready):
            yield _two([sig[ready].view(_U)], [sid[ready]])
        last, before = (sig[-1:], sid[-1:]), bool(shared[-1])
    if last is not None and before:
        yield _two([last[0].view(_U)], [last[1]])


def _whole_sets(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [shingle_set(t, shingle) for t in byte_texts(batch.column("text").slice(at, 64))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_identity(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                     pa.array([parity_sketch(s, percent) for s in sets], pa.binary())], names=["key", "n", "elements", "sketch"])
    return run


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, folded to the shortest's length."""
    width = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(s, _U).reshape(-1, width), axis=0) for s in sketches])


def close_pairs(sketches: list[bytes], n: np.ndarray, root: np.ndarray, block: np.ndarray, crossed: bool,
                percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of different roots (and blocks, if ``crossed``) that their sketches leave possible."""
    words = _folded(sketches)
    for i in range(len(n) - 1):
        others = root[i + 1:] != root[i]
        if crossed:
            others &= block[i + 1:] != block[i]
        j = i + 1 + np.nonzero(others)[0]
        if len(j):
            apart = np.bitwise_count(words[j] ^ words[i]).sum(axis=1, dtype=np.int64)
            for hit in j[apart <= (100 - percent) * (n[j] + n[i]) // (100 + percent)].tolist():
                yield i, hit


def _compare(percent: int):
    columns = ("sig", "deal", "crossed", "block", "key", "root", "n", "sketch")

    def pairs_of(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        _, _, crossed, block, key, root, n, sketch = zip(*rows)
        names = {r: i for i, r in enumerate(dict.fromkeys(root))}
        for i, j in close_pairs(list(sketch), np.array(n), np.array([names[r] for r in root]), np.array(block), crossed[0], percent):
            yield min(key[i], key[j]), max(key[i], key[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input sorted by (sig, deal): one deal is held at a time."""
        held, out = [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                for pair in pairs_of(held):
                    out.append(pair)
                    if len(out) > 20_000:
                        yield ready()
            held.clear()

        def ready() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])
            out.clear()
            return rows

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if held and held[0][:2] != row[:2]:
                    yield from close()
                held.append(row)
        yield from close()
        if out:
            yield ready()
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar enough."""
    a = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("elements").alias("ea"))
    b = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("elements").alias("eb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("ea", "eb")).cast("bigint"))
    return pinned(both.filter(F.expr(f"100 * common >= {int(percent)} * (na + nb - common)")).select("a", "b"))


def _rooted(members: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return members.withColumn("root", F.col("key"))
    roots = components(links).withColumnRenamed("node", "key")
    return pinned(members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))


def similar_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, links): per row doc_id, n, key (identity of its set); and links (a, b) between keys, whose
    components are those of all pairs of sets that are similar enough."""
    texts = id_and_text(docs, id_col, text_col)
    rows = pinned(texts.mapInArrow(tidy(_profiles(shingle)), "doc_id bigint, n bigint, key binary, sid bigint"))
    signed = texts.mapInArrow(tidy(_sign(shingle, percent)), "sig bigint, sid bigint")
    shared = pinned(signed.repartition("sig").sortWithinPartitions("sig", "sid").mapInArrow(tidy(_shared), "sig bigint, sid bigint"))
    weights = shared.groupBy("sid").agg(F.count(F.lit(1)).alias("weight"))
    # a short name that two sets share stands for both, so none is lost
    named = pinned(rows.filter("n > 0").join(weights, "sid").groupBy("sid", "key").agg(F.max("weight").alias("weight"),
                                                                                         F.min("doc_id").alias("least")))
    members = pinned(shared.join(named.select("sid", "key", "weight"), "sid").select("sig", "key", "weight"))

    ids = named.select(F.col("least").alias("_id")).distinct()
    if ids.limit(FEW_IDS + 1).count() <= FEW_IDS:
        ids = F.broadcast(ids)
    chosen = texts.join(ids, texts["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    sets = chosen.mapInArrow(tidy(_whole_sets(shingle, percent)),
                             "key binary, n bigint, elements array<bigint>, sketch binary")
    sets = pinned(sets.join(named.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]))

    links = None
    for _ in range(STARS):
        placed = _rooted(members, links)
        top = F.max(F.struct("weight", "key", "root"))
        mixed = placed.groupBy("sig").agg(top.alias("top"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
        rest = pinned(placed.join(mixed.select("sig", "top"), "sig").filter("key <> top.key")
                      .select("sig", "key", "weight", "root", F.col("top.key").alias("a"), F.col("top.root").alias("at")))
        pairs = rest.filter("root <> at").select("a", F.col("key").alias("b")).distinct()
        found = _verified(pairs, sets, percent)
        links = found if links is None else links.unionAll(found)
        members = rest.select("sig", "key", "weight")

    placed = _rooted(members, links)
    mixed = placed.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"),
                                      F.max("root").alias("high")).filter("low < high")
    dealt = (placed.join(mixed.select("sig", F.ceil(F.col("size") / DEAL).alias("blocks")), "sig")
             .withColumn("block", F.expr("pmod(xxhash64(key), blocks)"))
             .withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .withColumn("deal", F.expr("least(block, `with`) * blocks + greatest(block, `with`)"))
             .withColumn("crossed", F.expr("deal div blocks <> deal % blocks")))
    dealt = dealt.join(sets.select("key", "n", "sketch"), "key").select("sig", "deal", "crossed", "block", "key", "root", "n", "sketch")
    close = (dealt.repartition("sig", "deal").sortWithinPartitions("sig", "deal")
             .mapInArrow(tidy(_compare(percent)), "a binary, b binary").distinct())
    return rows, links.unionAll(_verified(close, sets, percent))


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable over links, itself included).

    Texts with fewer words than a shingle are one shingle as a whole.  Null
    texts and texts without words have no shingle and no link.  Repeated rows
    are kept; null ids never name a component that has another id.  Other
    columns are not read; an empty table gives no rows.
    """
    rows, links = similar_sets(docs, shingle, percent, id_col, text_col)
    roots = components(links).withColumnRenamed("node", "key")
    nodes = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    placed = pinned(nodes.join(roots, "key", "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = pinned(placed.join(names, "root").select("key", "component_id"))
    linked = rows.filter("n > 0").join(by_key, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionAll(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
