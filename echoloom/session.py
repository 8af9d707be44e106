"""Session settings and the shared scratch folder."""

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",   # rows come to many times that in a sort, which is to fit in memory
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.maxConcurrentOutputFileWriters": "64",      # a task writes its buckets side by side instead of sorting by them
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC) and the adaptive planner."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir as the session names it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/echoloom/{name}-{uuid.uuid4().hex[:12]}"
