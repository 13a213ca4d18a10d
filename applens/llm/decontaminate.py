"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions alone.

A mask is a pattern of token positions of which some do not count, so a seed
survives substitutions at those positions.  Every position of every document
gives one hash per mask; so does every position of every benchmark item.  Equal hashes
place an item on a diagonal of a document, and there the two are
compared token by token: the best run of agreeing tokens, with few enough
substitutions, decides.

Documents stay where they lie: positions are generated, hashed and looked up in one
pass, and only diagonals with a hit are shuffled, once each, with the document's tokens beside the item: a hit
never carries the whole document, of which a task would hold a copy for each hit.  The benchmark is broadcast if
its counted tokens and bytes are within bounds; for a larger one the hashes are shuffled instead, without their
documents, and those with a hit are fetched again.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 1: the token counts, 0: any token.  Two agreeing stretches of few tokens around a substitution are enough for one of them.
MASKS = ("1110111", "11011011", "1101000111")
# Of passages of 15 to 59 tokens with every tenth (fifth) token replaced, these find 99 % (91 %).
MIN_TOKENS = 10          # agreeing tokens that make an overlap; items that are shorter need MIN_SHARE of theirs
MIN_SHARE = 0.8
MISS_COST = 2            # one substitution is paid for by so many agreeing tokens
BROADCAST_TOKENS = 500_000       # of the benchmark; a seed of four numbers for each token and mask
BROADCAST_BYTES = 16 << 20       # of the benchmark's texts


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits; null and texts without any give an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seed(words: Column, pos: Column, number: int, mask: str) -> Column:
    """Hash of the mask's tokens from ``pos`` on; null where the mask does not fit."""
    picked = [F.get(words, pos + i) for i, c in enumerate(mask) if c == "1"]
    return F.when(pos + len(mask) <= F.size(words), F.xxhash64(F.lit(number), *picked))


def _seeds(words: Column, pos: Column, masks) -> Column:
    return F.array(*(_seed(words, pos, i, m) for i, m in enumerate(masks)))


def _best_run(same: Column) -> Column:
    """Most agreeing tokens in a stretch of best score, an agreement counting 1 and a miss -MISS_COST."""
    start = F.struct(F.lit(0).alias("score"), F.lit(0).alias("hits"), F.lit(0).alias("best"), F.lit(0).alias("best_hits"))

    def step(acc: Column, agrees: Column) -> Column:
        score = acc["score"] + F.when(agrees, 1).otherwise(-MISS_COST)
        hits = acc["hits"] + agrees.cast("int")
        go_on = score > 0
        score, hits = F.when(go_on, score).otherwise(0), F.when(go_on, hits).otherwise(0)
        better = score > acc["best"]
        return F.struct(score.alias("score"), hits.alias("hits"), F.when(better, score).otherwise(acc["best"]).alias("best"),
                        F.when(better, hits).otherwise(acc["best_hits"]).alias("best_hits"))

    return F.aggregate(same, start, step, lambda acc: acc["best_hits"])


def needed(n_tokens: Column) -> Column:
    """Agreeing tokens that an item of so many tokens needs."""
    return F.least(F.lit(MIN_TOKENS), F.ceil(n_tokens * MIN_SHARE).cast("int"))


def _goes_on(words: Column, pos: Column, item: Column, at: Column, number: Column, masks) -> Column:
    """Whether the hit's mask also fits one token earlier, so that an earlier hit stands for the same diagonal."""
    def fits(mask):
        return reduce(and_, (F.get(words, pos - 1 + i) == F.get(item, at - 1 + i) for i, c in enumerate(mask) if c == "1"))

    return (pos > 0) & (at > 0) & reduce(or_, ((number == i) & fits(m) for i, m in enumerate(masks)))


def _beside(words: Column, n_item: Column, first: Column) -> Column:
    """The document's tokens beside an item whose first token is at ``first`` (maybe before the text)."""
    return F.slice(words, F.greatest(first, F.lit(0)) + 1, n_item - F.greatest(F.lit(0), -first))


def _agreeing(beside: Column, item: Column, first: Column) -> Column:
    """Agreeing tokens of the best run between an item and what :func:`_beside` gives for it."""
    item_part = F.slice(item, F.greatest(F.lit(0), -first) + 1, F.size(beside))
    return _best_run(F.zip_with(beside, item_part, lambda a, b: a == b))


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, masks=MASKS, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", broadcast_tokens: int = BROADCAST_TOKENS,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document and item that overlap: doc_id, item_id, n_matched (agreeing tokens of the best place).

    Items of fewer tokens than the shortest mask hold too little to go by and
    match nothing; null and empty texts on either side match nothing.  Repeated
    rows give one row per pair of ids; other columns are not read; without documents or items there are no rows.
    """
    items = (benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), tokens(F.col(item_text_col).cast("string")).alias("item"))
             .withColumn("item_key", F.xxhash64("item_id", "item")))
    seeds = (items.select("item_key", "item", F.posexplode("item").alias("at", "_"))
             .select("item_key", F.size("item").alias("n_item"), "at", F.explode(_seeds(F.col("item"), F.col("at"), masks)).alias("seed"))
             .filter("seed IS NOT NULL"))
    size = items.agg(F.sum(F.size("item")).alias("n"), F.sum(F.octet_length(F.concat_ws("", "item"))).alias("bytes")).first()
    small = (size["n"] or 0) <= broadcast_tokens and (size["bytes"] or 0) <= broadcast_bytes

    did, text = F.col(id_col).cast("bigint"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(did.alias("doc_id"), F.xxhash64(did, text).alias("key"), tokens(text).alias("words"))
    first = (F.col("pos") - F.col("at")).alias("first")
    if small:
        # all of this is one generated loop into the aggregate behind distinct(), which can spill; rows that leave such a
        # loop for anything else, like a lambda, wait in memory until the document is through
        hits = (words.select("doc_id", "words", F.posexplode("words").alias("pos", "_"))
                .select("doc_id", "words", "pos", F.posexplode(_seeds(F.col("words"), F.col("pos"), masks)).alias("mask", "seed"))
                .join(F.broadcast(seeds.drop("n_item")), "seed").join(F.broadcast(items.drop("item_id")), "item_key")
                .filter(~_goes_on(F.col("words"), F.col("pos"), F.col("item"), F.col("at"), F.col("mask"), masks))
                .select("doc_id", "item_key", first, _beside(F.col("words"), F.size("item"), first).alias("beside"))
                .distinct().join(F.broadcast(items), "item_key"))
    else:
        hits = (words.select("key", "words", F.posexplode("words").alias("pos", "_"))
                .select("key", "pos", F.explode(_seeds(F.col("words"), F.col("pos"), masks)).alias("seed"))
                .join(seeds, "seed").select("key", "item_key", "n_item", first).distinct()
                .join(words, "key")
                .select("doc_id", "item_key", "first", _beside(F.col("words"), F.col("n_item"), F.col("first")).alias("beside"))
                .join(items, "item_key"))
    found = hits.select("doc_id", "item_id", F.size("item").alias("n_item"),
                        _agreeing(F.col("beside"), F.col("item"), F.col("first")).alias("n_matched"))
    return (found.filter(F.col("n_matched") >= needed(F.col("n_item")))
            .groupBy("doc_id", "item_id").agg(F.max("n_matched").alias("n_matched")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, masks=MASKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose id overlaps no benchmark item; rows with a null id stay."""
    leaks = benchmark_overlaps(docs, benchmark, masks, id_col, text_col).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, docs[id_col] == leaks["_leak"], "left_anti")
