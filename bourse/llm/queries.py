"""Registered queries: each operator over its whole table, with production
parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bourse.llm.common import table
from bourse.llm.conversation_repair import repair_damaged
from bourse.llm.decontaminate import benchmark_matches
from bourse.llm.lm_scoring import score_texts
from bourse.llm.minhash_dedup import near_duplicates
from bourse.llm.packing import pack
from bourse.llm.page_text import page_texts
from bourse.llm.prefix_trie import ordered_turns, prefix_trie, with_shared_openings
from bourse.llm.quality import quality_rules
from bourse.llm.secrets import secret_scan
from bourse.llm.simhash_dedup import simhash_duplicates
from bourse.llm.suffix_dedup import repeated_passages
from bourse.llm.token_counts import section_token_counts
from bourse.llm.token_files import token_index, write_token_ids
from bourse.session import shared_dir

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    """The tokenizer file that comes with the tokenizers' package."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("removed")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "bourse", "token_ids")
    write_token_ids(table(spark, sf_dir, "documents"), path, vocabulary())
    return token_index(spark, path)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*with_shared_openings(ordered_turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash_dedup, op2_suffix_dedup, op3_decontaminate, op4_token_counts, op5_secret_scan,
        op6_token_files, op7_lm_scoring, op8_packing, op9_quality_rules, op10_page_text,
        op11_conversation_repair, op12_simhash_dedup, op13_prefix_trie)
}
