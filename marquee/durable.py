"""Cut lineage in shared storage, so that lost executors cost a re-read only."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def durable_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``, or else the context's own.

    There is no fallback: a folder that only one machine sees would lose data with it.
    ``local_session`` names one when it builds a session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getCheckpointDir()
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors can reach")
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{durable_dir(spark)}/marquee-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Against ``DataFrame.checkpoint`` the copy stays columnar: later readers
    prune columns and the file sizes give the join planner real statistics.
    """
    return written_at(df, scratch_path(df.sparkSession, label))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """As :func:`written`, at a path of :func:`scratch_path` that the caller keeps."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Drop a table at a path of :func:`scratch_path` that nothing reads any more."""
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def written_bucketed(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """As :func:`written`, one sorted file for each hash bucket of ``keys``: joins and groupings
    on these keys read the table where it lies, without an exchange.

    The files are in the shared folder; the session's catalogue knows them by a new name."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    laid = df.repartition(buckets, *keys).write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    laid.saveAsTable(name)
    return spark.table(name)


def ensure_ml_checkpoints(spark: SparkSession) -> None:
    """Iterative MLlib fits (ALS) cut their lineage through the context setting."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(durable_dir(spark))
