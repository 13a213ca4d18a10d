"""Word-piece token counts by a longest-match automaton, in time linear in the text.

The vocabulary is a trie of word-initial pieces and one of continuing pieces.
Every node has a failure link: the node that stands for what is left once the
longest pieces that the match so far settles are split off, and beside it how
many pieces that is.  Walking a word byte by byte, following the link where
no child fits, and adding up those counts gives the greedy longest-match length
without building a piece and without stepping back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from applens.llm.common import byte_texts, id_and_text, tidy

WORDS_KEPT = 500_000
LONG_WORD = 200


class PieceAutomaton:
    """Counts greedy longest-match pieces of words."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes]):
        self.children: list[dict[int, int]] = [{}, {}]        # node 0: start of a word; node 1: start of a continuing piece
        ends = [False, False]

        def grow(node: int, piece: bytes) -> None:
            for b in piece:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    ends.append(False)
                node = nxt
            ends[node] = True

        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                if piece:
                    grow(root, piece)
        n = len(self.children)
        self.fail, self.popped = [-1] * n, [0] * n
        level = [0, 1]
        while level:                                          # breadth first: links lead to nodes that are done
            following = []
            for u in level:
                for b, v in self.children[u].items():
                    if ends[v]:
                        self.fail[v], self.popped[v] = 1, 1
                    else:
                        z, count = self.fail[u], self.popped[u]
                        while z >= 0 and b not in self.children[z]:
                            count += self.popped[z]
                            z = self.fail[z]
                        if z >= 0:
                            self.fail[v], self.popped[v] = self.children[z][b], count
                    following.append(v)
            level = following

    def count(self, word: bytes) -> int:
        """Number of pieces; a word that the pieces cannot build counts as one."""
        children, fail, popped = self.children, self.fail, self.popped
        node, total = 0, 0
        for b in word:
            nxt = children[node].get(b)
            while nxt is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                nxt = children[node].get(b)
            node = nxt
        while node > 1:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


def byte_pieces(path: str) -> tuple[set[bytes], set[bytes]]:
    """Word-initial and continuing pieces of a byte-level vocabulary file.

    A token with a leading space begins words; one without continues them; every single byte does both.
    """
    import json
    # the published byte alphabet of such files: visible Latin-1 characters stand for themselves, the rest follow from U+0100 on
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    tokens = [bytes(byte_of[c] for c in t) for t in vocab if all(c in byte_of for c in t)]
    single = {bytes([b]) for b in range(256)}
    return ({t[1:] for t in tokens if t[:1] == b" " and len(t) > 1} | single,
            {t for t in tokens if t[:1] != b" "} | single)


@lru_cache(maxsize=2)
def _automaton(path: str) -> PieceAutomaton:
    return PieceAutomaton(*byte_pieces(path))


def text_counts(automaton: PieceAutomaton, texts: Iterable[bytes], words_kept: int = WORDS_KEPT) -> Iterator[tuple[int, int]]:
    """(words, pieces) of each text; counts of words seen before are remembered up to a bound."""
    known: dict[bytes, int] = {}
    for text in texts:
        words = text.split()
        try:
            yield len(words), sum([known[w] for w in words])
            continue
        except KeyError:
            pass
        if len(known) > words_kept:
            known.clear()
        total = 0
        for w in words:
            n = known.get(w)
            if n is None:
                n = automaton.count(w)
                if len(w) <= LONG_WORD:
                    known[w] = n
            total += n
        yield len(words), total


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(path)

        def texts(ids: list) -> Iterator[bytes]:
            for batch in batches:
                ids.append(batch.column("doc_id"))
                yield from byte_texts(batch.column("text"))

        ids: list = []
        counts: list[tuple[int, int]] = []

        def batch_out() -> pa.RecordBatch:
            whole = pa.concat_arrays(ids)
            n = np.array(counts, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([whole.slice(0, len(n)), pa.array(n[:, 0]), pa.array(n[:, 1])],
                                              names=["doc_id", "n_words", "n_tokens"])

        for pair in text_counts(automaton, texts(ids)):
            counts.append(pair)
            if len(counts) == sum(map(len, ids)):
                yield batch_out()
                ids.clear()
                counts.clear()
    return run


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words (runs without white space), n_tokens (greedy word pieces of all of them).

    Null and empty texts count nothing; repeated rows count each; a word of any
    length is walked whole; other columns are not read; an empty table gives no rows.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(_count(vocabulary)), "doc_id bigint, n_words bigint, n_tokens bigint")
