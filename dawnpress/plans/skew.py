"""Joins in which one key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: A key with more than this share of all rows is hot, so there are fewer than ``HOT_KEYS`` of them at
#: any size; a key with no more than ``LEAST_ROWS`` rows is none.
HOT_KEYS, LEAST_ROWS = 1024, 1000


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores where it is too small to make a split for each of them, as one small file is; a
    large table is left as it is, and so is a small one whose files make a split for each core."""
    spark = df.sparkSession
    cores, split = spark.sparkContext.defaultParallelism, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * split or len(df.inputFiles()) >= cores and _even(df, cores):
        return df
    return df.repartition(cores)


def _even(df: DataFrame, cores: int) -> bool:
    """Whether no split holds more than two cores' share of the rows. Only the files' footers are read."""
    most, total = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return total is None or most * cores <= 2 * total


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> list[Row]:
    """The hot keys, out of how many rows each key has. Most tables have none: one look tells."""
    top = counts.where(F.col(n) > LEAST_ROWS).orderBy(F.desc(n), *keys).limit(HOT_KEYS).collect()
    if not top:
        return []
    total = counts.agg(F.sum(n)).first()[0]
    return [Row(**{k: r[k] for k in keys}) for r in top if r[n] * HOT_KEYS > total]


def join_spread(many: DataFrame, one: DataFrame, keys: list[str], hot: list[Row], how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, which has a row for each key at most. The rows of ``many`` with a hot key
    stay where they are and meet ``one``'s few rows of such keys by broadcast; all others are shuffled."""
    if not hot:
        return many.join(one, keys, how)
    listed = F.broadcast(many.sparkSession.createDataFrame([tuple(r) for r in hot], many.select(*keys).schema))  # by place, whatever the keys' names
    few = F.broadcast(one.join(listed, keys, "left_semi"))
    here = many.join(listed, keys, "left_semi").join(few, keys, how)
    return many.join(listed, keys, "left_anti").join(one, keys, how).unionByName(here)
