"""The registered queries of this subpackage and the SQL that expresses some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dawnpress.llm import ann, bwt_dedup, decontam, fim, hard_negatives, line_dedup, lm_score, mixing, ngram_join, quality, secrets, token_store, toxicity
from dawnpress.plans.skew import spread

END_ID = 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(_docs(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_lm(_docs(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_docs(spark, sf_dir))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove_repeats(_docs(spark, sf_dir))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_index(_docs(spark, sf_dir), tokenizer_path(), END_ID)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_docs(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_lines(_docs(spark, sf_dir))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_docs(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.moved_labels(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_toxicity, op3_lm_scoring, op4_secret_scan, op5_benchmark_decontamination,
        op6_suffix_array_dedup, op7_token_store, op8_quality_rules, op9_line_dedup, op10_source_mixing,
        op11_nearest_neighbours, op12_fill_in_middle, op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op8_quality_rules": quality.ORACLE, "op9_line_dedup": line_dedup.ORACLE,
    "op11_nearest_neighbours": ann.ORACLE, "op12_fill_in_middle": fim.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
