"""The registered queries, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, decontaminate, jaccard_join, language, minhash, packing, pii, quality_model, quality_rules, sentence_dedup, spelling, suffix_dedup, toxicity
from .frames import table

# Files of the public tokenizer; every executor has them in the same place.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).select(*kept)


ORACLE["op1_quality_rules"] = quality_rules.oracle()


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_language(table(spark, sf_dir, "documents"))


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.remove_repeated_sentences(table(spark, sf_dir, "documents"), every=True).drop("kept")


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, RANKS)


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


@query
def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


ORACLE["op12_ngram_jaccard_join"] = jaccard_join.oracle()


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLE["op13_spelling_variants"] = spelling.oracle()
