"""The numbered queries: each applies its operator to whole tables and derives the columns that are asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontam, langid, lexical_search, line_dedup, oracles, quality_model, quality_rules, run_detection, simhash, substring_dedup, suffix_dedup, threshold_search, toxicity
from ledgerlake.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.dedup(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.dedup(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(read(spark, sf_dir, "documents"), TOKENIZER))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(simhash.near_duplicates(read(spark, sf_dir, "documents")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_detection.detect(read(spark, sf_dir, "documents"), plant=True, texts=False)


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_search.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontaminate, op2_divergence, op3_line_dedup, op4_quality, op5_toxicity, op6_language, op7_suffix_dedup, op8_substring_dedup, op9_bpe, op10_simhash, op11_lexical_search, op12_runs, op13_vector_search)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": oracles.DECONTAMINATE, "op2_divergence": oracles.DIVERGENCE, "op8_substring_dedup": oracles.SUBSTRING_DEDUP, "op11_lexical_search": oracles.LEXICAL_SEARCH, "op13_vector_search": oracles.VECTOR_SEARCH}
