"""Helpers the training-data operators share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.sources.tables import shared_folder

# The white space of the contracts: ASCII space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"
# Rows of a few keys and numbers that one task writes to one file.
LIGHT_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new place in the shared folder and read it back: lineage ends here, lost executors don't matter."""
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def stored_light(df: DataFrame, name: str, about: int) -> DataFrame:
    """``stored`` for ``about`` so many rows of a few keys and numbers, in as few files as keep every core busy and LIGHT_ROWS rows in each.

    Every file costs a task that writes it and its share of the next read, however few rows it holds.
    """
    return stored(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-about // LIGHT_ROWS))), name)


def whole_text(name: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def own_name(df: DataFrame, name: str) -> str:
    """A column name ``df`` does not use."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that functions sent to them find it and keep what they loaded."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        held = tempfile.mkdtemp(prefix="reelhouse-")
        code = shutil.copytree(package, f"{held}/code/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{held}/{package.name}", "zip", code.removesuffix(package.name)))
        _shipped.add(context.applicationId)
