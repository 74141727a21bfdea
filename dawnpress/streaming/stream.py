"""Streaming forms: keyed exactly-once append, edition windows, and recomposing touched editions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dawnpress.functions.text import edition_date
from dawnpress.operators.edition import window_bounds
from dawnpress.operators.incremental import ClusterState
from dawnpress.sources.store import Table


def article_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def edition_counts(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Articles per edition window (a day from 22:00 UTC), late ones up to ``late``."""
    return stream.withWatermark("published_at", late).groupBy(F.window("published_at", "1 day", "1 day", "22 hours")).agg(F.count(F.lit(1)).alias("n_articles"), F.approx_count_distinct("domain").alias("n_sources")).select(F.date_add(F.to_date("window.end"), 1).alias("edition"), "n_articles", "n_sources")


def first_seen(stream: DataFrame, key: str = "article_id", late: str = "2 days") -> DataFrame:
    return stream.withWatermark("published_at", late).dropDuplicatesWithinWatermark([key])


def append_and_recompose(stream: DataFrame, table: Table, recompose: Callable[[DataFrame, list[date]], None], checkpoint: str, key: str = "article_id") -> StreamingQuery:
    """Append each batch's new rows once, then recompose the editions that they touch. A batch that is run
    again finds its rows stored and adds nothing."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        table.append_ignore(df, key, F.col(key))
        touched = [r[0] for r in df.where("published_at is not null").select(edition_date("published_at").alias("e")).distinct().collect()]
        if touched:
            # bounds that reach the scan, then the editions themselves
            low, high = window_bounds(min(touched))[0], window_bounds(max(touched))[1]
            near = table.read().where((F.col("published_at") >= F.lit(low).cast("timestamp_ntz")) & (F.col("published_at") < F.lit(high).cast("timestamp_ntz")))
            recompose(near.where(edition_date("published_at").isin(touched)), sorted(touched))
        df.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_clusters(stream: DataFrame, state: ClusterState, recompose: Callable[[list[date]], None], checkpoint: str) -> StreamingQuery:
    """Take each batch of articles, late ones included, into the clusters of ``state``, then call ``recompose`` with the
    editions that it touched. A batch that is run again changes nothing more."""

    def batch(df: DataFrame, number: int) -> None:
        touched = state.update(df.where("published_at is not null").withColumn("edition", edition_date("published_at")))
        if touched:
            recompose(touched)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
