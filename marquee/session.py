"""Session settings the operators are written for.

On a cluster the caller brings the session; ``local_session`` is for tests and
the benchmark only.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings worth carrying over to a cluster session as well.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "marquee", cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    name_scratch(spark)
    return spark


def name_scratch(spark: SparkSession) -> None:
    """Give a local session without ``spark.checkpoint.dir`` a folder, gone when Python ends."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or not context.master.startswith("local["):
        return
    folder = tempfile.mkdtemp(prefix="marquee-scratch-")
    context.setCheckpointDir(folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
