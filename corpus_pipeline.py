"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dawnpress.llm import decontam, mixing, ngram_join, quality, token_store
from dawnpress.llm.queries import END_ID, tokenizer_path
from dawnpress.plans.lineage import table_path
from dawnpress.plans.skew import spread


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps; a null text has no words and goes."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class; of repeated rows of one id, one stays. Rows without
    words or without a doc_id stay."""
    return ngram_join.keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text does not cover an item of the benchmark, whatever their id."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words once. A null source is one of its own."""
    return mixing.take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids stand in the token store, read back from it; a null text is the end id alone."""
    return token_store.token_index(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mixing),
    ("token store", token_output),
]

#: SQL has no tokenizer, no tiling and no dependent rounding. tests/llm/test_pipeline.py holds each stage's
#: rows against SQL (quality), brute force (near duplicates, tiling), the targets (mixing: random, but
#: bounded for each source) and the tokenizer itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        path = table_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
