"""Cutting lineage: intermediate results become Parquet tables in the shared folder.

The folder is the one that the cluster names in ``spark.checkpoint.dir``. Where that setting is missing,
a temporary folder is made if all runs in one process (tests), and an error is raised if not: executors
would each write to a folder of their own. Tables written there survive the
loss of any executor, and reading them again never recomputes what stands before them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="dawnpress-")
    return _LOCAL[app]


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/dawnpress/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the DataFrame that reads it."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables made by :func:`cut` that nothing reads any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    for df in frames:
        for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(hadoop).delete(path, True)
