"""Spark session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join strategies from real sizes, merges small partitions and splits
# skewed ones. Partition targets keep a task's data well inside executor memory.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str = "reelhouse", shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with the settings above.

    ``shuffle_partitions`` is the starting number that adaptive execution merges down; on a
    large cluster choose the shuffled bytes divided by the advisory partition size.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
