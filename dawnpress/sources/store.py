"""Keyed tables on Parquet: append-ignore, upsert, append, fill-null, lookups.

Each function is a DataFrame operation on (stored, incoming); ``Table`` applies them to a folder. Keys
are enforced by an anti-join and a dedup on the key, both of which combine before the shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dawnpress.schema import align


def first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("__n = 1").drop("__n")


def append_ignore(stored: DataFrame, incoming: DataFrame, key: str, order: Column) -> DataFrame:
    """The rows of ``incoming`` to add: the first per key that is not stored."""
    return first_per_key(incoming, key, order).join(stored.select(key), key, "left_anti")


def upsert(stored: DataFrame, incoming: DataFrame, key: str, at: str) -> DataFrame:
    """The whole table after it: the latest row per key, incoming over stored."""
    columns = stored.columns
    both = stored.withColumn("__new", F.lit(0)).unionByName(incoming.select(columns).withColumn("__new", F.lit(1)))
    return both.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct("__new", at)).alias("r")).select("r.*")


def fill_null(stored: DataFrame, found: DataFrame, key: str, column: str) -> DataFrame:
    """The whole table with ``column`` taken from ``found`` where it is null; nothing is overwritten."""
    return stored.join(found.select(key, F.col(column).alias("__found")), key, "left").withColumn(column, F.coalesce(column, "__found")).select(stored.columns)


def last_wins(found: DataFrame, key: str, column: str, order: str) -> DataFrame:
    return found.where(F.col(column).isNotNull()).groupBy(key).agg(F.max_by(column, order).alias(column))


def lookup(wanted: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Stored columns beside the wanted keys, null where there are none."""
    return wanted.join(stored, key, "left")


def coverage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_filled"), F.floor(100 * F.count(column) / F.greatest(F.count(F.lit(1)), F.lit(1))).cast("long").alias("percent"))


class Table:
    """A keyed table in a folder. A write makes a new part and then a new version, a numbered list of the
    parts that count; nothing that a reader may look at is ever deleted or replaced. A version counts once
    it is complete, so a writer that is lost on the way leaves the table as it was. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _version(self) -> int:
        """The newest complete version, 0 before the first."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [int(f.getPath().getName()) for f in fs.listStatus(path)] if fs.exists(path) else []
        done = lambda n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{n:09d}/_SUCCESS"))
        return next((n for n in sorted(found, reverse=True) if done(n)), 0)

    def _current(self) -> list[str]:
        n = self._version()
        return [r[0] for r in self.spark.read.text(f"{self.path}/versions/{n:09d}").orderBy("value").collect()] if n else []

    def read(self) -> DataFrame:
        parts = self._current()
        return align(self.spark.read.option("mergeSchema", True).parquet(*parts), self.schema) if parts else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame, keep: list[str]) -> None:
        n = self._version() + 1
        part = f"{self.path}/part-{n:09d}-{uuid.uuid4().hex}"
        align(df, self.schema).write.parquet(part)
        # a half-written list of the same number would be a lost writer's: it is the only thing overwritten
        self.spark.createDataFrame([(p,) for p in [*keep, part]], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/versions/{n:09d}")

    def append(self, df: DataFrame) -> None:
        self._write(df, self._current())

    def replace(self, df: DataFrame) -> None:
        self._write(df, [])

    def append_ignore(self, df: DataFrame, key: str, order: Column) -> int:
        """Adds what is new; returns how many rows that was."""
        before = self._current()
        self._write(append_ignore(self.read(), df, key, order), before)
        return self.spark.read.parquet(self._current()[-1]).count()

    def upsert(self, df: DataFrame, key: str, at: str) -> None:
        self.replace(upsert(self.read(), align(df, self.schema), key, at))

    def fill_null(self, found: DataFrame, key: str, column: str) -> int:
        before = self.read().where(F.col(column).isNotNull()).count()
        self.replace(fill_null(self.read(), found, key, column))
        return self.read().where(F.col(column).isNotNull()).count() - before
