"""Schemas of stored tables, and reading what was stored before a column existed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE = "article_id string, url string, domain string, title string, summary string, published_at timestamp_ntz, fetched_at timestamp_ntz, feed string, category string, weight double, image string, lang string"
FEED_STATE = "url string, etag string, last_modified string, body_hash string, last_success timestamp_ntz"
RUN_METRIC = "run_id string, feed string, at timestamp_ntz, status string, n_items int, n_new int, duration double, note string"
TRANSLATION = "source string, result string, at timestamp_ntz"
FEED = "name string, url string, category string, weight double, lang string, note string"
BRONZE = "source string, url string, status int, fetched_at timestamp_ntz, etag string, last_modified string, sha256 string, n_bytes int, duration double, body binary"


def align(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with exactly the schema's columns; a missing one is null, idempotently."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema).fields))
