"""From raw documents to token files, in five stages of the corpus operators.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; :func:`run` writes its
result as Parquet in the shared folder and rereads it as the next stage's
documents, so a lost executor costs at most the stage under way; a stage's folder is
removed once the next one is written.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from applens.llm import decontaminate, mixing, quality, simhash, token_output
from applens.llm.common import remove, scratch, table
from applens.llm.queries import tokenizer_path

# SQL can express neither the classifier nor the fingerprints; tests/llm holds each stage against a brute-force version
# and run() against the stages.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.near_deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written and read back: their places, lengths and checksums."""
    return token_output.token_ids(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID output", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
