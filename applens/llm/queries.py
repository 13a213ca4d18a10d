"""Registered queries of the corpus operators; DuckDB SQL where SQL can express one is in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from applens.llm import (decontaminate, exact_dedup, html_extract, mixing, partenum, prefix_trie, quality, repair,
                         simhash, suffix_dedup, token_count, token_output, url_filter)
from applens.llm.common import table
from applens.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# fixed values: the rules of the op1 contract
URL_RULES = (url_filter.Rule("allow", "org/"), url_filter.Rule("block", "example.org/es/"),
             url_filter.Rule("block", "example.org/en/1"), url_filter.Rule("allow", "com/fr/"),
             url_filter.Rule("block", "com/de/"))


def op1_url_filter(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages"), URL_RULES)


def op2_html_extraction(spark, sf):
    return html_extract.main_texts(table(spark, sf, "pages"))


def op3_decontamination(spark, sf):
    return decontaminate.benchmark_overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_suffix_dedup(spark, sf):
    return suffix_dedup.without_repeats(table(spark, sf, "documents"))


def op5_quality(spark, sf):
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_token_counts(spark, sf):
    return token_count.token_counts(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_token_output(spark, sf):
    return token_output.token_ids(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


def op9_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op10_source_mixing(spark, sf):
    return mixing.mix_report(table(spark, sf, "documents"))


def op11_ngram_jaccard(spark, sf):
    return partenum.similar_documents(table(spark, sf, "documents"))


def op12_conversation_repair(spark, sf):
    return repair.repaired(table(spark, sf, "conversations"))


def op13_prefix_trie(spark, sf):
    return prefix_trie.prefix_nodes(table(spark, sf, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_extraction": op2_html_extraction,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_token_counts": op6_token_counts,
    "op7_token_output": op7_token_output,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_simhash": op9_simhash,
    "op10_source_mixing": op10_source_mixing,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
