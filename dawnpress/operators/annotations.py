"""Annotations of articles, apart from the articles: a model may change, a text does not.

A row is what one version of a model says of one article. Versions stay beside each other, so that a new one never
rewrites articles and can be compared with the one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dawnpress.functions import rules
from dawnpress.sources.store import append_ignore

ANNOTATION = "article_id long, model string, version string, annotated_at timestamp_ntz, score double, label string, topics array<string>, events array<string>"
KEY = ["article_id", "model", "version"]


def annotate(articles: DataFrame, version: str, at: Column, article_id: str = "article_id", model: str = "rules") -> DataFrame:
    """What the rules say of ``articles(article_id, title, summary)``: direction, topics, and the kinds of events."""
    seen = articles.withColumn("hits", rules.found()).withColumn("d", rules.direction())
    events = F.filter(F.array(F.when(rules.disaster(hits=F.col("hits")), F.lit("disaster"))), lambda x: x.isNotNull())
    return seen.select(
        F.col(article_id).cast("long").alias("article_id"), F.lit(model).alias("model"), F.lit(version).alias("version"), at.cast("timestamp_ntz").alias("annotated_at"),
        F.col("d.score").cast("double").alias("score"), F.col("d.label").alias("label"), rules.themes(hits=F.col("hits")).alias("topics"), events.alias("events"),
    )


def new_annotations(stored: DataFrame, made: DataFrame) -> DataFrame:
    """The rows of ``made`` whose article no stored row of the same model and version annotates."""
    key = lambda df: df.withColumn("__key", F.struct(*KEY))
    return append_ignore(key(stored), key(made), "__key", F.col("annotated_at")).drop("__key")


def compare_versions(annotations: DataFrame, model: str, before: str, after: str) -> DataFrame:
    """For each label of the version before: the articles of both versions, how many have another label after, how
    many other topics, and the mean change of the score."""
    of = lambda v, k: annotations.where((F.col("model") == model) & (F.col("version") == v)).select("article_id", F.col("label").alias(f"label{k}"), F.col("score").alias(f"score{k}"), F.array_sort("topics").alias(f"topics{k}"))
    both = of(before, 0).join(of(after, 1), "article_id")
    return both.groupBy(F.col("label0").alias("label")).agg(
        F.count(F.lit(1)).alias("n_articles"), F.count_if(~F.col("label0").eqNullSafe(F.col("label1"))).alias("n_relabelled"),
        F.count_if(~F.col("topics0").eqNullSafe(F.col("topics1"))).alias("n_topics_changed"), F.avg(F.col("score1") - F.col("score0")).alias("mean_change"),
    )
