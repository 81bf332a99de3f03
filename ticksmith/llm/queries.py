"""Registered queries of this folder: thin projections of each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm.common import table
from ticksmith.llm.oracle import ORACLE

#: tokens above which a text counts as over the limit
TOKEN_LIMIT = 512


def op1_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.pages import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op4_string_tiling_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_kmeans_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.embeddings import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_chunked_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.substrings import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"), within=True)


def op7_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.katz import katz

    return katz(table(spark, sf_dir, "documents"))


def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.packing import pack
    from ticksmith.llm.tokens import tokenizer_path

    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.templates import document_lines

    return document_lines(table(spark, sf_dir, "documents"))


def op10_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.tokens import prefix_counts, tokenizer_path

    counts = prefix_counts(table(spark, sf_dir, "documents"), tokenizer_path(), budget=TOKEN_LIMIT)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fit_chars")


def op11_one_bit_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.negatives import mine

    return mine(table(spark, sf_dir, "embeddings"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.prefixes import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.llm.codes import read_documents, write_codes
    from ticksmith.llm.tokens import tokenizer_path

    return read_documents(spark, write_codes(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_style_tree": op1_site_style_tree,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_crf_toxicity": op3_crf_toxicity,
    "op4_string_tiling_decontamination": op4_string_tiling_decontamination,
    "op5_kmeans_embedding_dedup": op5_kmeans_embedding_dedup,
    "op6_chunked_substring_dedup": op6_chunked_substring_dedup,
    "op7_katz_scoring": op7_katz_scoring,
    "op8_mixture_packing": op8_mixture_packing,
    "op9_line_template_dedup": op9_line_template_dedup,
    "op10_prefix_token_counts": op10_prefix_token_counts,
    "op11_one_bit_hard_negatives": op11_one_bit_hard_negatives,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_direct_codes": op13_direct_codes,
}


__all__ = ["ORACLE", "QUERIES"]
