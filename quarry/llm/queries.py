"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import (chat_formatting, decontamination, jaccard_join, license_scan, line_dedup, minhash_dedup, packing, prefix_trie,
                        quality_classifier, quality_rules, spelling_variants, suffix_dedup, token_output)

BYTE_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pieces(packing.pack(spark, docs, public_tokenizers.path(BYTE_TOKENIZER)))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"))
    # what is left, as text (a cut may lie inside a character)
    return cut.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(spark, _table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_formatting.format_sides(chat_formatting.other_answers(_table(spark, sf_dir, "conversations")))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_output.ids_by_document(spark, docs, public_tokenizers.path(WORD_TOKENIZER))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark, _table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(spark, _table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(spark, _table(spark, sf_dir, "documents"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefixes(spark, _table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(spark, _table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_token_output": op7_token_output,
    "op8_license_scan": op8_license_scan,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_line_dedup": op10_line_dedup,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
SQL: dict[str, str] = {
    "op6_chat_formatting": chat_formatting.SQL,
    "op8_license_scan": license_scan.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
