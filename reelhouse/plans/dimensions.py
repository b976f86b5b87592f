"""Calendar and store dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.functions.dates import MONTHS_EN, calendar_parts

# Store ids and source codes. Display names default to the codes.
STORES = {1: "BB", 2: "MS", 3: "MMM"}
CALENDAR = ("2005-01-01", "2012-12-31")

_DATE_COLUMNS = ["temps_id", "date_complete", "jour", "mois", "nom_mois", "trimestre", "annee"]


def dim_store(spark: SparkSession, names: dict[int, str] | None = None, addresses: dict[int, str] | None = None) -> DataFrame:
    """(magasin_id, nom, adresse) for the three stores."""
    names, addresses = names or STORES, addresses or {}
    ids = spark.range(1, len(STORES) + 1, numPartitions=1).select(F.col("id").cast("int").alias("magasin_id"))
    return ids.select(
        "magasin_id",
        F.elt("magasin_id", *[F.lit(names[i]) for i in STORES]).alias("nom"),
        F.elt("magasin_id", *[F.lit(addresses.get(i)).cast("string") for i in STORES]).alias("adresse"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1], months: tuple[str, ...] = MONTHS_EN) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    n_days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    days = spark.range(n_days, numPartitions=1).select(
        (F.col("id") + 1).cast("int").alias("temps_id"),
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_complete"),
    )
    return days.withColumns(calendar_parts(F.col("date_complete"), months)).select(*_DATE_COLUMNS)


def dim_date_of(df: DataFrame, col: str, months: tuple[str, ...] = MONTHS_EN) -> DataFrame:
    """Calendar of the whole years touched by a date column."""
    day = F.to_date(col)
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.trunc("lo", "year").alias("start"), F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("end")
    )
    days = span.select("start", F.explode(F.sequence("start", "end")).alias("date_complete"))
    days = days.withColumn("temps_id", F.date_diff("date_complete", "start") + 1)
    return days.withColumns(calendar_parts(F.col("date_complete"), months)).select(*_DATE_COLUMNS)
