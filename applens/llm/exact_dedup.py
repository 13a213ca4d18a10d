"""Exact copies by Patricia tries that own each text.

Normal forms are dealt to partitions by the band of their length and the first
bits of their content hash.  The texts of a partition go, as whole byte
strings, into one compressed radix trie, where texts share the bytes they
begin with; the node at which a text ends keeps the best row seen so far and a
count.  Equal texts meet in their node and nowhere else: the hash only says
which trie a text belongs to.

Each task first builds tries over its own rows, so a text that fills a third of
the table leaves a task as one row.  When their labels pass a bound, subtrees (a
prefix and all that begins with it) are sent on and dropped, the largest that are
needed.  What was sent on is dealt by partition, sorted, and inserted again into
tries that hold neighbouring partitions until their bytes pass the bound.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import SPACE, byte_texts, id_and_text, tidy

TASK_BYTES = 96 << 20          # what a task's tries hold before subtrees are sent on, or a trie is closed
BATCH_BYTES = 8 << 20
NODE_BYTES = 250               # counted for a node beside its label
HASH_BYTES = 3                 # of the content hash that choose a partition; the texts of one have to fit a task
COARSE = 4                     # bits of them by which a task's own tries are kept apart
_SPACE_BYTES = SPACE.encode()
_PARTIAL = "band int, bucket int, body binary, hash binary, n_points bigint, doc_id bigint, n bigint"


def _shared_length(a: bytes, b: bytes) -> int:
    """How many leading bytes are equal."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n                 # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner = label, {}, None


def better(a: tuple, b: tuple) -> bool:
    """Owners are (code points, id, count, hash): more code points first, then the smaller id; null ids last."""
    return (-a[0], a[1] is None, a[1] or 0) < (-b[0], b[1] is None, b[1] or 0)


class PatriciaTrie:
    """Byte strings with the owner of each; ``held`` are the bytes of its labels and nodes."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def insert(self, key: bytes, owner: tuple) -> bool:
        """Adds one row for ``key``; true if the string is new."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                leaf = Node(key[at:])
                leaf.owner = owner
                node.children[key[at]] = leaf
                self.held += len(leaf.label) + NODE_BYTES
                return True
            rest = key[at:at + len(child.label)]
            same = len(rest) if rest == child.label else _shared_length(rest, child.label)
            if same < len(child.label):          # split the edge
                upper = Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                child = upper
                self.held += NODE_BYTES
            node, at = child, at + same
        if node.owner is None:
            node.owner = owner
            return True
        best = owner if better(owner, node.owner) else node.owner
        node.owner = (best[0], best[1], owner[2] + node.owner[2], *owner[3:])
        return False

    def owners(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, tuple]]:
        """(string, owner) of all strings, or of those below ``node``, before which ``prefix`` lies."""
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            text = prefix + node.label
            if node.owner is not None:
                yield text, node.owner
            stack.extend((c, text) for c in node.children.values())

    def terminals(self) -> Iterator[tuple]:
        """The owners alone."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.owner is not None:
                yield node.owner
            stack.extend(node.children.values())

    def _sizes(self) -> dict[int, int]:
        """Bytes held by the subtree of each node."""
        order, sizes = [self.root], {}
        for node in order:
            order.extend(node.children.values())
        for node in reversed(order):
            sizes[id(node)] = len(node.label) + NODE_BYTES + sum(sizes[id(c)] for c in node.children.values())
        return sizes

    def cut(self, target: int) -> Iterator[tuple[bytes, tuple]]:
        """Removes subtrees, of those that are not larger than needed the largest first, until ``target`` bytes are held; gives their strings."""
        if self.root.owner is not None and self.held > target:
            yield b"", self.root.owner
            self.root.owner = None
        while self.held > target and self.root.children:
            yield from self._cut_once(target)      # what is left of a node whose branches all went goes in the next turn

    def _cut_once(self, target: int) -> Iterator[tuple[bytes, tuple]]:
        sizes = self._sizes()

        def branches(node: Node, prefix: bytes):
            return [(-sizes[id(c)], prefix, first, node) for first, c in node.children.items()]

        heap = branches(self.root, b"")
        heapq.heapify(heap)
        while heap and self.held > target:
            size, prefix, first, above = heapq.heappop(heap)
            node = above.children[first]
            if -size > self.held - target and node.children:      # a part of it is enough
                for branch in branches(node, prefix + node.label):
                    heapq.heappush(heap, branch)
                continue
            del above.children[first]
            self.held += size
            yield from self.owners(node, prefix)


def normal_form(text: bytes) -> bytes:
    return text.translate(None, _SPACE_BYTES)


def partition_of(body: bytes, digest: bytes) -> tuple[int, int]:
    """(band of lengths, first bits of the content hash)."""
    return len(body).bit_length(), int.from_bytes(digest[:HASH_BYTES], "big")


def _partial_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("band", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary()), ("hash", pa.binary()), ("n_points", pa.int64()),
                        ("doc_id", pa.int64()), ("n", pa.int64())])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _local_owners(task_bytes: int):
    def sent(strings: Iterator[tuple[bytes, tuple]]) -> Iterator[tuple]:
        for body, (n_points, doc_id, n, digest) in strings:
            yield (*partition_of(body, digest), body, digest, n_points, doc_id, n)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tries: dict[tuple[int, int], PatriciaTrie] = {}
        held = 0
        for batch in batches:
            ids, points = batch.column("doc_id").to_pylist(), pc.utf8_length(batch.column("text")).to_pylist()
            for doc_id, n_points, text in zip(ids, points, byte_texts(batch.column("text"))):
                body = normal_form(text)
                digest = hashlib.sha256(body).digest()
                band, bucket = partition_of(body, digest)
                trie = tries.setdefault((band, bucket >> 8 * HASH_BYTES - COARSE), PatriciaTrie())
                held -= trie.held
                trie.insert(body, (n_points or 0, doc_id, 1, digest))
                held += trie.held
                if held > task_bytes:            # subtrees of long texts first; short ones cost little and come again
                    for key in sorted(tries, reverse=True):
                        trie = tries[key]
                        if held > task_bytes // 2:
                            held -= trie.held
                            yield from sent(trie.cut(max(0, task_bytes // 2 - held)))
                            held += trie.held
        for trie in tries.values():
            yield from sent(trie.owners())

    return lambda batches: _partial_batches(rows(batches))


def _global_owners(task_bytes: int):
    names = ["text_sha256", "keep_id", "group_size"]

    def closed(trie: PatriciaTrie) -> Iterator[pa.RecordBatch]:
        out = [(digest.hex(), doc_id, n) for _, doc_id, n, digest in trie.terminals()]
        for at in range(0, len(out), 10_000):
            columns = zip(zip(*out[at:at + 10_000]), (pa.string(), pa.int64(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input sorted by partition; a trie holds partitions of one band until its bytes pass the bound."""
        key, trie = None, PatriciaTrie()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for band, bucket, body, digest, *owner in zip(*(part.column(c).to_pylist()
                                                                for c in ("band", "bucket", "body", "hash", "n_points", "doc_id", "n"))):
                    if (band, bucket) != key:
                        if key is not None and (band != key[0] or trie.held > task_bytes):
                            yield from closed(trie)
                            trie = PatriciaTrie()
                        key = band, bucket
                    trie.insert(body, (*owner, digest))
        yield from closed(trie)
    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha = [hashlib.sha256(normal_form(t)).hexdigest() for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sha, pa.string())], names=["doc_id", "text_sha256"])


def text_owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per distinct normal form: text_sha256, keep_id, group_size."""
    rows = id_and_text(docs, id_col, text_col)
    partial = rows.mapInArrow(tidy(_local_owners(task_bytes)), _PARTIAL)
    return (partial.repartition("band", "bucket").sortWithinPartitions("band", "bucket")
            .mapInArrow(tidy(_global_owners(task_bytes)), "text_sha256 string, keep_id bigint, group_size bigint"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_bytes: int = TASK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without the characters ``[\\x20\\x09-\\x0D]``;
    null counts as empty, so null, empty and blank texts are one group.  Of
    equal texts the row with the most code points stays, then the smallest id
    (null ids last).  A repeated row (same id, same text) counts each time and
    each such row is kept if its id is the one that stays.  Columns other than
    the two named are not read; an empty table gives no rows.
    """
    members = id_and_text(docs, id_col, text_col).mapInArrow(tidy(_hashes), "doc_id bigint, text_sha256 string")
    return (members.join(text_owners(docs, id_col, text_col, task_bytes), "text_sha256")
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
