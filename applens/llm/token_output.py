"""Token ids as Parquet list columns.

Texts are dealt into ranges of ascending id, encoded, and written by Spark's
Parquet writer: one row per document, ids as ``array<int>``.  The id column is
dictionary encoded (a 49k vocabulary needs 16 bits an id); the ascending
columns have no dictionary, and under the format's second version get delta
encoding.  Row groups and pages have set sizes, and the writer adds column and
offset indexes, so a reader of some documents or of the metadata alone touches
only those pages.

The tokenizer drops white space, so a text's ids are its words' ids one after
another; each distinct word is encoded once while a worker remembers it and kept as bytes.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, id_and_text, scratch, tidy

END_ID = 1
WORDS_KEPT = 250_000          # distinct words a worker remembers before it starts afresh
LONG_WORD = 200               # bytes; longer runs are encoded but not remembered
BATCH_BYTES = 4 << 20           # ids handed on at once
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
FILE_SCHEMA = "doc_id bigint, shard int, pos bigint, n_tokens bigint, ids array<int>"


# Words of these characters are one pre-token that normalises letter by letter, so the
# model alone encodes them; a tail of these marks is the next pre-token.
_LAST_PLAIN, _NOT_PLAIN = "\u024f", "\u0130"
_TAIL = b".,!?;:#$%&*|-+=()"


def _plain_letters(word: bytes) -> bool:
    if word.isascii():
        return word.isalpha()
    text = word.decode("utf-8", "replace")
    return text.isalpha() and max(text) <= _LAST_PLAIN and _NOT_PLAIN not in text


def _byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: visible Latin-1 as is, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes whole texts word by word with a tokenizer that never joins across white space."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.no_truncation()
        self._tok.no_padding()
        self._model = self._tok.model
        self._alphabet = _byte_alphabet()
        self._known: dict[bytes, bytes] = {}
        self._words_kept = words_kept

    def _whole(self, word: bytes) -> bytes:
        ids = self._tok.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _letters(self, word: bytes) -> bytes:
        """Ids of a word of plain letters."""
        piece = word.decode().lower().encode().decode("latin-1").translate(self._alphabet) if not word.isascii() else word.decode("ascii").lower()
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _new(self, word: bytes) -> bytes:
        core = word.rstrip(_TAIL)
        if not _plain_letters(core):
            return self._whole(word)
        # capitals and tails are many, the lower-case words behind them fewer
        known, key = self._known, core.lower()
        ids = known.get(key)
        if ids is None:
            ids = self._letters(key)
            if len(key) <= LONG_WORD:
                known[key] = ids
        if len(core) == len(word):
            return ids
        tail = word[len(core):]
        end = known.get(tail)
        if end is None:
            end = self._whole(tail)
            if len(tail) <= LONG_WORD:
                known[tail] = end
        return ids + end

    def encode(self, text: bytes) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        words = text.split()
        known = self._known
        out = list(map(known.get, words))
        if None in out:
            if len(known) > self._words_kept:
                known.clear()
            for i, ids in enumerate(out):
                if ids is None:
                    word = words[i]
                    ids = known.get(word)
                    if ids is None:
                        ids = self._new(word)
                        if len(word) <= LONG_WORD:
                            known[word] = ids
                    out[i] = ids
        return b"".join(out)


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder a worker process, so its words serve the tasks that follow."""
    return WordEncoder(path)


def _encode_partition(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pos, shard = None, 0, TaskContext.get().partitionId()
        tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            encoder = encoder or _encoder(path)
            ids, rows, held, start = [], [], 0, 0
            doc_ids = batch.column("doc_id")
            for i, text in enumerate(byte_texts(batch.column("text"))):
                ids.append(encoder.encode(text) + tail)
                held += len(ids[-1])
                if held > BATCH_BYTES or i == batch.num_rows - 1:
                    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                    values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.slice(start, n), pa.array(np.full(n, shard, np.int32)),
                         pa.array(np.arange(pos, pos + n)), pa.array(lengths),
                         pa.ListArray.from_arrays(pa.array(offsets), values)],
                        names=["doc_id", "shard", "pos", "n_tokens", "ids"])
                    ids, held, start, pos = [], 0, start + n, pos + n
    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID, files: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text", row_group_bytes: int = ROW_GROUP_BYTES,
                    page_bytes: int = PAGE_BYTES) -> None:
    """Writes the ids of every whole text to ``path`` in ascending id order.

    Null and empty texts hold the end id alone.  Rows of one id follow one
    another in the order of their texts' hashes; null ids come first.  Columns
    other than the two named are not read.  An empty table gives an empty one.
    ``files`` defaults to the session's shuffle partitions.
    """
    spark = docs.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs, id_col, text_col)
    (rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(tidy(_encode_partition(tokenizer, end_id)), FILE_SCHEMA)
     .write.mode("errorifexists")
     .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.enable.dictionary", "false").option("parquet.enable.dictionary#ids.list.element", "true")
     .parquet(path))


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        ends = np.asarray(ids.offsets)
        values = memoryview(np.ascontiguousarray(np.asarray(ids.values), dtype="<i4")).cast("B")
        crc = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        counts = pa.array((ends[1:] - ends[:-1]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("shard"), batch.column("pos"), counts, pa.array(crc, pa.int64())],
            names=["doc_id", "shard", "pos", "n_tokens", "ids_crc32"])


def token_digest(written: DataFrame) -> DataFrame:
    """Per written document: its place in the whole sequence, its length, and a checksum of its ids.

    Places are sums within a file range, moved by the sums of the ranges before
    it; there is one such sum for each range, so that side is small at any size.
    """
    rows = written.mapInArrow(tidy(_digest), "doc_id bigint, shard int, pos bigint, n_tokens bigint, ids_crc32 bigint")
    totals = written.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(F.broadcast(offsets), "shard")
            .select("doc_id", (F.col("offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_ids(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """Writes all ids to a new folder under the shared one, reads them back, and returns the digest."""
    spark = docs.sparkSession
    path = scratch(spark, "token-ids")
    write_token_ids(docs, path, tokenizer, end_id)
    return token_digest(read_token_ids(spark, path))
