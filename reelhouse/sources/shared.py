"""The folder every executor can reach, and tables written there on the way."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, set here only for local runs without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="reelhouse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new place in the shared folder and read back: its lineage ends there."""
    place = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _open, _before = Lock(), Counter(), {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries started inside remove their shuffle files when they end; else those stay until the driver collects its garbage.

    The session's own setting holds again after the last of those that are inside at the same time.
    """
    with _lock:
        if not _open[spark]:
            _before[spark] = spark.conf.get(_REMOVAL, "false")
            spark.conf.set(_REMOVAL, "true")
        _open[spark] += 1
    try:
        yield
    finally:
        with _lock:
            _open[spark] -= 1
            if not _open[spark]:
                del _open[spark]
                spark.conf.set(_REMOVAL, _before.pop(spark))
