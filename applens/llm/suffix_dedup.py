"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Every string of ``length`` bytes (a window) that starts anywhere else in the
corpus is found by sorting suffixes; only the suffixes that can matter are sorted:

1. Each window is represented by its smallest k-gram hash, its anchor.  Equal
   windows have equal anchors at equal places.  The windows in a row that share an
   anchor form a context.  Each task sums up equal contexts before the shuffle.
2. Contexts meet by anchor.  A context seen twice repeats as a whole, whatever
   else holds its anchor; one whose anchor is seen nowhere else holds no repeat.  Neither needs sorting.
3. The bytes of the others are fetched and dealt by anchor.  A task sorts one
   block of whole anchors at a time, and in it one suffix bucket at a time: by the first
   ``V`` bytes, and where these tie by the ranks of difference-cover samples, which are computed once a block by
   doubling.  For any two suffixes the cover has a step at which both are samples, so a tie of any length costs one comparison.
   Neighbours in the order that agree on ``length`` bytes are repeats.

A block is bounded in bytes.  Anchors with more contexts than a block should hold are
settled by counting their windows' hashes, an aggregate that needs no group in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, pinned, tidy

LENGTH = 200
GRAM = 50                      # bytes of an anchor
CHUNK = 1 << 19                # bytes hashed at once
BLOCK = 1 << 19                # bytes sorted at once
HOT_CONTEXTS = 4096            # contexts of one anchor that still go to one block
# fixed values: a perfect difference set, every difference modulo 31 is that of two of its members
V = 31
COVER = (1, 5, 11, 24, 25, 27)

_MIX, _MIX2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 22
_NO_ID = -(1 << 63)            # stands for a null id while rows are joined
_OCCURRENCE = ("h bigint, c bigint, n int, a int, refs array<struct<key: bigint, did: bigint, lo: int>>")


_VALUES = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)      # a random number for each byte value
_BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    def powers(b: int) -> np.ndarray:
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]))
    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


class PrefixHashes:
    """Hashes of any string of a text from those of its prefixes; equal strings have equal hashes wherever they lie."""

    def __init__(self, x: np.ndarray):
        power, self._inverse = _powers_to(1 << max(20, len(x).bit_length()))
        self._prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[x] * power[:len(x)])])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._prefix[end] - self._prefix[start]) * self._inverse[start]
        return (h ^ (h >> np.uint64(32))) * _MIX


def anchors(x: np.ndarray, owner: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Contexts of a run of texts: (first window, windows, anchor's place, anchor hash, context hash).

    ``owner`` numbers the text of each byte; windows do not cross texts.
    """
    n, per = len(x), length - gram + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = PrefixHashes(x)
    at = np.arange(n - gram + 1)
    h = hashes.spans(at, at + gram)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    low = (h & ~mask) | at.astype(np.uint64)
    size = 1
    while size * 2 <= per:                       # least of `size` k-grams in a row
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < per:
        low = np.minimum(low[:len(low) - (per - size)], low[per - size:])
    whole = np.flatnonzero(owner[:n - length + 1] == owner[length - 1:])
    if not len(whole):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    place = (low & mask).astype(np.int64)[whole]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)]))
    count = np.diff(np.append(first, len(whole)))
    lo, place = whole[first], place[first]
    c = hashes.spans(lo, lo + count - 1 + length)
    c = (c + (place - lo).astype(np.uint64) * _MIX2) * _MIX + count.astype(np.uint64)
    return lo, count, place, h[place], c ^ (c >> np.uint64(31))


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, did, first byte, bytes); long texts come in pieces that share no window."""
    for key, did, text in zip(batch.column("key").to_pylist(), batch.column("did").to_pylist(), byte_texts(batch.column("text"))):
        for at in range(0, max(1, len(text) - length + 1), CHUNK):
            yield key, did, at, text[at:at + CHUNK + length - 1]


def _occurrences(length: int, gram: int):
    def out(pieces: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch | None:
        x = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        sizes = np.array([len(p[3]) for p in pieces])
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        lo, n, place, h, c = anchors(x, owner, length, gram)
        if not len(lo):
            return None
        order = np.lexsort((lo, c, h))            # equal contexts side by side, to be one row
        lo, n, place, h, c = lo[order], n[order], place[order], h[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
        who = owner[lo]
        begin = np.cumsum(sizes) - sizes
        refs = pa.StructArray.from_arrays(
            [pa.array(np.array([p[0] for p in pieces], np.int64)[who]), pa.array(np.array([p[1] for p in pieces], np.int64)[who]),
             pa.array((lo - begin[who] + np.array([p[2] for p in pieces])[who]).astype(np.int32))], names=["key", "did", "lo"])
        return pa.RecordBatch.from_arrays(
            [pa.array(h[first].view(np.int64)), pa.array(c[first].view(np.int64)), pa.array(n[first].astype(np.int32)),
             pa.array((place - lo)[first].astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(np.append(first, len(lo)).astype(np.int32)), refs)], names=["h", "c", "n", "a", "refs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in _pieces(batch, length):
                if len(piece[3]) < length:
                    continue
                held.append(piece)
                size += len(piece[3])
                if size >= CHUNK:
                    found = out(held)
                    held, size = [], 0
                    if found is not None:
                        yield found
        found = out(held) if held else None
        if found is not None:
            yield found
    return run


def _words(x: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([x, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(x), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(x)]
    return out


def _dense(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Ranks for a sorted order, equal where all keys are equal."""
    change = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        change[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(change)
    return rank


class CoverRanks:
    """Ranks of the difference-cover samples of a text, by at least ``reach`` bytes."""

    def __init__(self, x: np.ndarray, words: np.ndarray, reach: int):
        n = len(x)
        self.sample = np.concatenate([np.arange(r, n, V) for r in COVER])
        # the place of text position q in `sample`, by residue
        self._base = np.full(V, -1)
        at = 0
        for r in COVER:
            self._base[r] = at
            at += len(range(r, n, V))
        q = self.sample
        keys = [words[np.minimum(q + k, n - 1)] * (q + k < n) for k in (0, 8, 16, V - 8)]
        rank, reached = _dense(np.lexsort(keys[::-1]), keys), V
        while reached < reach and len(q):
            nxt = q + reached
            there = np.where(nxt < n, rank[np.where(nxt < n, self.place(np.minimum(nxt, n - 1), check=False), 0)] + 1, 0)
            both = [rank, there]
            rank, reached = _dense(np.lexsort(both[::-1]), both), reached * 2
        self.rank = rank
        # the first step after which both a suffix of residue a and one of residue b are samples
        members = set(COVER)
        self.step = np.array([[next(d for d in range(V) if (a + d) % V in members and (b + d) % V in members) for b in range(V)]
                              for a in range(V)])

    def place(self, q: np.ndarray, check: bool = True) -> np.ndarray:
        return self._base[q % V] + q // V

    def at(self, q: np.ndarray, n: int) -> np.ndarray:
        """Rank of the sample at q; places past the end come first."""
        inside = q < n
        return np.where(inside, self.rank[np.where(inside, self.place(np.where(inside, q, int(COVER[0]))), 0)] + 1, 0)


def sorted_suffixes(x: np.ndarray, starts: np.ndarray, reach: int) -> np.ndarray:
    """``starts`` in the order of their suffixes, compared over at least ``reach`` bytes; one bucket of first bytes at a time."""
    n = len(x)
    words = _words(x)
    cover = CoverRanks(x, words, reach)
    out = []
    by_first = starts[np.argsort(x[starts], kind="stable")]
    turns = np.flatnonzero(np.diff(x[by_first].astype(np.int16))) + 1
    for bucket in np.split(by_first, turns):
        if not len(bucket):
            continue
        keys = [words[np.minimum(bucket + k, n - 1)] * (bucket + k < n) for k in (0, 8, 16, V - 8)]
        order = np.lexsort(keys[::-1])
        tie = _dense(order, keys)[order]
        bucket = bucket[order]
        residue = bucket % V
        # within a tie, suffixes of one residue compare by the ranks one step away
        own = cover.at(bucket + cover.step[residue, residue], n)
        order = np.lexsort((own, tie))
        bucket, residue = bucket[order], residue[order]
        first = np.flatnonzero(np.concatenate([[True], tie[1:] != tie[:-1]]))
        last = np.append(first[1:], len(bucket))
        high, low = np.maximum.reduceat(residue, first), np.minimum.reduceat(residue, first)
        for g in np.flatnonzero(high != low).tolist():          # ties of several residues: pair by pair
            a, b = int(first[g]), int(last[g])

            def compare(i: int, j: int) -> int:
                step = int(cover.step[i % V, j % V])
                ri, rj = (int(cover.rank[cover.place(np.int64(q + step))]) + 1 if q + step < n else 0 for q in (i, j))
                return (ri > rj) - (ri < rj)
            bucket[a:b] = sorted(bucket[a:b].tolist(), key=cmp_to_key(compare))
        out.append(bucket)
    return np.concatenate(out) if out else starts[:0]


def repeated_windows(bodies: list[bytes], counts: list[int], anchor: list[int], length: int) -> list[np.ndarray]:
    """For each body, which of its first ``counts`` windows also start elsewhere in the bodies.

    Bodies are laid out with their anchors at one residue of the cover's period, so that
    equal windows nearly always tie within a residue.
    """
    parts, base, at = [], [], 0
    for body, a in zip(bodies, anchor):
        gap = -(at + a) % V
        parts.append(bytes(gap))
        base.append(at + gap)
        parts.append(body)
        at += gap + len(body)
    x = np.frombuffer(b"".join(parts), np.uint8)
    n = np.array(counts)
    starts = np.repeat(np.array(base) - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    order = sorted_suffixes(x, starts, length)
    h = PrefixHashes(x).spans(order, order + length)
    same = np.flatnonzero(h[1:] == h[:-1])
    # neighbours with equal hashes are compared byte by byte
    for k in range(0, len(same), 1 << 14):
        i, j = order[same[k:k + (1 << 14)]], order[same[k:k + (1 << 14)] + 1]
        grid = np.arange(length)
        same[k:k + (1 << 14)][~(x[i[:, None] + grid] == x[j[:, None] + grid]).all(axis=1)] = -1
    same = same[same >= 0]
    hit = np.zeros(len(x), bool)
    hit[order[same]] = hit[order[same + 1]] = True
    return [hit[b:b + k] for b, k in zip(base, counts)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def _fetch(length: int):
    """Bodies of the asked-for contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "c", "n", "a", "sure", "key", "did", "lo", "body"]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        rows, size = [], 0
        for batch in batches:
            for key, did, text, asked in zip(batch.column("key").to_pylist(), batch.column("did").to_pylist(),
                                             byte_texts(batch.column("text")), batch.column("asked").to_pylist()):
                for r in asked:
                    rows.append((r["h"], r["c"], r["n"], r["a"], r["sure"], key, did, r["lo"], text[r["lo"]:r["lo"] + r["n"] - 1 + length]))
                    size += len(rows[-1][8])
                    if size > BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


_SPAN = "key bigint, did bigint, lo int, hi int"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                      names=["key", "did", "lo", "hi"])


def _sort_blocks(length: int):
    """Input dealt and sorted by anchor: blocks of whole anchors, each sorted at once."""
    def settle(rows: list[tuple]) -> list[tuple]:
        found = repeated_windows([r[8] for r in rows], [r[2] for r in rows], [r[3] for r in rows], length)
        return [(r[5], r[6], r[7] + a, r[7] + b + length) for r, flags in zip(rows, found) if not r[4] for a, b in _runs(flags)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, group, size, last = [], [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "c", "n", "a", "sure", "key", "did", "lo", "body"))):
                if row[0] != last:
                    if len(group) > 1:
                        block.extend(group)
                        size += sum(len(r[8]) for r in group)
                    if size > BLOCK:
                        found = settle(block)
                        block, size = [], 0
                        if found:
                            yield _span_batch(found)
                    group, last = [], row[0]
                group.append(row)
        if len(group) > 1:
            block.extend(group)
        found = settle(block) if block else []
        if found:
            yield _span_batch(found)
    return run


def _window_hashes(length: int):
    """Two hashes of every window of a hot anchor's contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, sure, key, did, lo, body in zip(*(batch.column(c).to_pylist() for c in ("n", "sure", "key", "did", "lo", "body"))):
                x = np.frombuffer(body, np.uint8)
                at = np.arange(n)
                w1 = PrefixHashes(x).spans(at, at + length)
                w2 = PrefixHashes(x ^ np.uint8(0x55)).spans(at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.full(n, key)), pa.array(np.full(n, did)),
                     pa.array((lo + at).astype(np.int32)), pa.array(np.full(n, bool(sure)))], names=["w1", "w2", "key", "did", "at", "sure"])
    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), batch.column("spans").to_pylist()):
            merged: list[list[int]] = []
            for s in sorted((s["lo"], s["hi"]) for s in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            ends = [0, *(e for _, e in merged)]
            kept = hashlib.sha256()
            for a, (b, _) in zip(ends, [*merged, (len(text), 0)]):
                kept.update(text[a:b])
            rows.append((doc_id, len(text), sum(b - a for a, b in merged), len(merged), kept.hexdigest(),
                         [{"lo": a, "hi": b} for a, b in merged]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_contexts: int = HOT_CONTEXTS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (maximal removed runs, as byte places).

    Texts are UTF-8 bytes; null counts as empty.  A byte is removed if a string
    of ``length`` bytes that covers it also starts anywhere else, in this text or any other; all copies go.  Texts
    shorter than that keep everything.  Repeated rows are texts like any other, so they remove each other.  Null ids
    are kept.  Other columns are not read; an empty table gives no rows.
    """
    did = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # both joins below shuffle the texts by the same keys with the same columns, so Spark shuffles them once
    texts = docs.select(F.xxhash64(did, text).alias("key"), did.alias("did"), text.alias("text"))
    met = texts.mapInArrow(tidy(_occurrences(length, gram)), _OCCURRENCE).repartition("h")
    same, of_anchor = Window.partitionBy("h", "c"), Window.partitionBy("h")
    first_ref = F.col("refs")[0]
    seen = (met.withColumn("m", F.sum(F.size("refs")).over(same))
            .withColumn("leads", F.row_number().over(same.orderBy(first_ref["key"], first_ref["did"], first_ref["lo"])) == 1)
            .withColumn("contexts", F.sum(F.col("leads").cast("int")).over(of_anchor))
            .filter("m > 1 OR contexts > 1"))
    seen = pinned(seen)
    ref = F.col("ref")
    whole = (seen.filter("m > 1").select("n", F.explode("refs").alias("ref"))
             .select(ref["key"].alias("key"), ref["did"].alias("did"), ref["lo"].alias("lo"),
                     (ref["lo"] + F.col("n") - 1 + length).cast("int").alias("hi")))
    asked = (seen.filter("leads AND contexts > 1")
             .select(first_ref["key"].alias("key"), first_ref["did"].alias("did"),
                     F.struct("h", "c", "n", "a", (F.col("m") > 1).alias("sure"), first_ref["lo"].alias("lo"),
                              (F.col("contexts") > hot_contexts).alias("hot")).alias("ask"))
             .groupBy("key", "did").agg(F.collect_list("ask").alias("asked")))

    def bodies(hot: bool) -> DataFrame:
        mine = asked.select("key", "did", F.filter("asked", lambda r: r["hot"] == hot).alias("asked")).filter(F.size("asked") > 0)
        return (texts.join(mine, ["key", "did"])
                .mapInArrow(tidy(_fetch(length)), "h bigint, c bigint, n int, a int, sure boolean, key bigint, did bigint, lo int, body binary"))

    parts = whole.unionAll(bodies(False).repartition("h").sortWithinPartitions("h").mapInArrow(tidy(_sort_blocks(length)), _SPAN))
    if not seen.filter(F.col("contexts") > hot_contexts).isEmpty():
        windows = bodies(True).mapInArrow(tidy(_window_hashes(length)), "w1 bigint, w2 bigint, key bigint, did bigint, at int, sure boolean")
        again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        parts = parts.unionAll(windows.filter("NOT sure").join(again, ["w1", "w2"], "left_semi")
                               .select("key", "did", F.col("at").alias("lo"), (F.col("at") + length).cast("int").alias("hi")))
    # repeated rows (one id, one text) bring the same spans each; one of each is kept, else every copy would get those of all
    spans = parts.distinct().groupBy("key", "did").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    doc_id = F.nullif("did", F.lit(_NO_ID)).alias("doc_id")
    return (texts.join(spans, ["key", "did"], "left").select(doc_id, "text", "spans")
            .mapInArrow(tidy(_remove), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                                 "spans array<struct<lo: bigint, hi: bigint>>"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """What the contract of the query asks for: everything but the spans."""
    return repeated_spans(docs, length).drop("spans")
